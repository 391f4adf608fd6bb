"""Daily full snapshots of accounts, videos and comments.

Each takes the snapshot of the day before (None when bootstrapping) and the day's inputs, which
may span several days when a history is folded in one go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import ms_to_text, ms_to_timestamp
from tidemark.functions.derive import (
    account_age_days,
    age_by_days,
    birth_year,
    is_official,
    tag_array,
    vip_state,
)
from tidemark.functions.json_paths import extract_json, json_fields
from tidemark.functions.labels import account_status_name, vip_type_name
from tidemark.operators.relations import (
    CHUNK_IDS,
    LISTS,
    relation_chunks,
    relation_counts,
    relation_lists,
)
from tidemark.operators.rows import require
from tidemark.operators.snapshots import carried_total, fold_by_key, latest_by_key, newer_wins, stamp
from tidemark.schemas import cast_to_schema, table_schema
from tidemark.sources.raw import scan_raw

# Entity message fields.
PROFILE_FIELDS = """
mid bigint
nick_name string
sex string
face_url string
sign string
level int
birthday string
coins decimal(12,2)
status int
official_type int official_verify.type
official_desc string official_verify.desc
privacy_show_fav boolean settings.privacy.show_fav
privacy_show_history boolean settings.privacy.show_history
push_comment boolean settings.push.comment
push_like boolean settings.push.like
push_at boolean settings.push.at
theme string settings.theme
tags_json string tags
created_ms bigint created_at
updated_ms bigint updated_at
"""
CONTENT_FIELDS = """
bvid string
title string
cover string
desc_text string
duration int
pubdate bigint
mid bigint
category_id int
category_name string
state int
attribute int
is_private boolean
upload_ip string meta_info.upload_ip
camera string meta_info.camera
software string meta_info.software
resolution string meta_info.resolution
fps int meta_info.fps
created_at bigint
updated_at bigint
audit_info string
meta_info string
stats string
"""
COMMENT_ENTITY_FIELDS = """
rpid bigint
oid string
otype int
mid bigint
root bigint
parent bigint
content string
state int
created_at bigint
updated_at bigint
"""
PROFILE_DEFAULTS = {
    "official_type": -1,
    "privacy_show_fav": False,
    "privacy_show_history": False,
    "push_comment": True,
    "push_like": True,
    "push_at": True,
}
VIDEO_TOTALS = {
    "view_count": "view_count",
    "danmaku_count": "danmaku_count",
    "reply_count": "reply_delta",
    "favorite_count": "net_favorite_delta",
    "coin_count": "coin_total_delta",
    "share_count": "share_count",
    "like_count": "net_like_delta",
}
COMMENT_TOTALS = {
    "like_count": "net_like_delta",
    "dislike_count": "net_dislike_delta",
    "reply_count": "reply_count_delta",
}


def profiles(raw: DataFrame, dt: str | list[str] | None) -> DataFrame:
    """The newest profile message per account. Equal times fall back to the message text."""
    rows = scan_raw(raw, "app_user_profile", dt)
    fields = json_fields(PROFILE_FIELDS)
    parsed = require(extract_json(rows, fields, carry=("json_str",)), not_null=("mid",))
    return latest_by_key(parsed, ["mid"], ["updated_ms", "json_str"]).drop("json_str")


# What newest_paid_orders reads of order events, beside order, account, event and time.
PAID_INPUT = ["new_vip_expire_ts", "plan_duration_days"]


def newest_paid_orders(orders: DataFrame) -> DataFrame:
    """Per account the latest paid order that sets an expiry."""
    paid = orders.where(F.col("order_status") == "success")
    paid = require(paid, not_null=("mid", "new_vip_expire_ts"))
    newest = latest_by_key(paid, ["mid"], ["pay_end_ts", "order_no"])
    return newest.select("mid", "new_vip_expire_ts", F.col("plan_duration_days").alias("plan_days"))


def _profile_columns(dt: str) -> dict[str, Column]:
    birthday, kind = F.col("birthday"), F.col("official_type")
    tags = tag_array(F.col("tags_json"))
    return {
        "age": age_by_days(birthday, F.lit(dt)),
        "birth_year": birth_year(birthday),
        "status_name": account_status_name(F.col("status")),
        "is_official": is_official(kind),
        "tags": tags,
        "tag_cnt": F.size(tags),
        "primary_tag": F.get(tags, F.lit(0)),
        "created_at": ms_to_timestamp("created_ms"),
        "updated_at": ms_to_timestamp("updated_ms"),
        "account_age_days": account_age_days(F.col("created_ms"), F.lit(dt)),
        **{name: F.coalesce(F.col(name), F.lit(value)) for name, value in PROFILE_DEFAULTS.items()},
    }


PROFILE_CARRIED = (
    "nick_name sex face_url sign level birthday age birth_year coins status status_name official_type "
    "official_desc is_official privacy_show_fav privacy_show_history push_comment push_like push_at "
    "theme tags tag_cnt primary_tag created_at updated_at account_age_days"
).split()


def large_account_lists(pairs: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """The lists of the accounts that have more relations than one chunk holds, as chunks."""
    return relation_chunks(pairs, relation_counts(pairs), chunk_ids).where("chunks > 1")


def account_snapshot(
    dt: str,
    run_ts: Column,
    profile: DataFrame,
    pairs: DataFrame,
    orders: DataFrame,
    previous: DataFrame | None,
    expire_unit: str = "ms",
    carry_forward: bool = False,
    inline_limit: int | None = None,
    lists: bool = True,
) -> DataFrame:
    """The account snapshot of ``dt``.

    ``pairs`` is the rolled-forward relation state of the day. Accounts are all that occur in the
    day's profiles, social events and paid orders or in the snapshot before. Profile columns come
    from today's messages only; ``carry_forward`` keeps yesterday's where there is none.

    List columns hold every member, however many relations an account has. With ``inline_limit`` they stay null
    above that many and :func:`large_account_lists` holds them in chunks, so that both together have every member;
    without ``lists`` they are null, for readers of the other columns. Counts are always exact.
    Everything meets on ``mid``: each input is shuffled by it once.
    """
    counts = relation_counts(pairs)
    parts = {
        "profile": profile.withColumn("has_profile", F.lit(True)),
        "relations": counts,
        "paid": newest_paid_orders(orders),
    }
    if previous is not None:
        kept = previous.select("mid", "vip_type", "vip_expire", *(PROFILE_CARRIED if carry_forward else ()))
        parts["old"] = kept.withColumnsRenamed({c: f"old_{c}" for c in kept.columns if c != "mid"})
    known = fold_by_key(parts, ["mid"]).select("mid", *(f"{name}.*" for name in parts))
    if lists:
        # Both sides are partitioned by mid already, so the lists are not moved once more.
        known = known.join(relation_lists(pairs, counts, inline_limit), "mid", "left")
    if previous is None:
        known = known.withColumns(
            {"old_vip_type": F.lit(None).cast("int"), "old_vip_expire": F.lit(None).cast("timestamp")}
        )
    expire, kind = vip_state(
        dt,
        F.col("new_vip_expire_ts"),
        F.col("plan_days"),
        F.col("old_vip_expire"),
        F.col("old_vip_type"),
        expire_unit,
    )
    shaped = known.withColumns(_profile_columns(dt))
    if carry_forward and previous is not None:
        shaped = shaped.withColumns(
            {
                c: F.when(F.col("has_profile"), F.col(c)).otherwise(F.coalesce(F.col(f"old_{c}"), F.col(c)))
                for c in PROFILE_CARRIED
            }
        )
    sizes = [f"{name}_cnt" for name in LISTS]
    empty, none = (value.cast("array<bigint>") for value in (F.array(), F.lit(None)))
    columns = {f"{name}_list": F.coalesce(F.col(f"{name}_list"), empty) if lists else none for name in LISTS}
    if lists and inline_limit is not None:
        total = sum((F.coalesce(F.col(size), F.lit(0)) for size in sizes), F.lit(0))
        columns = {name: F.when(total <= inline_limit, column) for name, column in columns.items()}
    zero = {name: F.coalesce(F.col(name), F.lit(0)) for name in (*sizes, "following_chg", "follower_chg")}
    done = shaped.withColumns({**columns, "vip_expire": expire, "vip_type": kind}).withColumns(
        {**zero, "vip_type_name": vip_type_name(F.col("vip_type")), "dw_create_time": run_ts}
    )
    return cast_to_schema(done.where(F.col("mid").isNotNull()), table_schema("dim_account_df"))


def video_content(raw: DataFrame, dt: str | list[str] | None) -> DataFrame:
    """Video messages as snapshot attributes, several per video possible."""
    parsed = extract_json(scan_raw(raw, "app_video_content", dt), json_fields(CONTENT_FIELDS))
    return require(parsed, not_null=("bvid",)).withColumns(
        {
            "created_date": ms_to_text("created_at", "yyyy-MM-dd"),
            "updated_date": ms_to_text("updated_at", "yyyy-MM-dd"),
            "pub_date": ms_to_text("pubdate", "yyyy-MM-dd"),
        }
    )


def comment_entities(raw: DataFrame, dt: str | list[str] | None) -> DataFrame:
    """Comment messages as snapshot attributes, several per comment possible."""
    parsed = extract_json(scan_raw(raw, "app_comment", dt), json_fields(COMMENT_ENTITY_FIELDS))
    return require(parsed, not_null=("rpid", "oid")).withColumns(
        {
            "created_date": ms_to_text("created_at", "yyyy-MM-dd"),
            "updated_date": ms_to_text("updated_at", "yyyy-MM-dd"),
            "is_root": F.coalesce(F.col("root") == 0, F.lit(False)),
        }
    )


def _rolled(
    table: str,
    keys: list[str],
    totals: dict[str, str],
    messages: DataFrame,
    stats: DataFrame,
    previous: DataFrame | None,
    dt: str,
    run_ts: Column,
    extra: DataFrame | None = None,
) -> DataFrame:
    """Newest attributes plus totals: yesterday's total and today's delta, stamped where touched.

    Keys are those of the snapshot before, of the messages and of the stats; ``extra`` deltas (one
    column) add no keys. The day's inputs are folded first and meet the big snapshot in one join.
    """
    names = [c for c in messages.columns if c not in keys]
    ties = [c for c in names if c != "updated_at"]
    deltas = [delta for delta in totals.values() if delta in stats.columns]
    parts = {
        "new": latest_by_key(messages, keys, ["updated_at", *ties]),
        "delta": stats.groupBy(*keys).agg(*(F.sum(delta).alias(delta) for delta in deltas)),
    }
    touched = F.col("delta").isNotNull()
    if extra is not None:
        more = [c for c in extra.columns if c not in (*keys, "dt")]
        parts["more"] = extra.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in more))
        touched = touched | F.col("more").isNotNull()
    changes = fold_by_key(parts, keys)
    if previous is None:
        kinds = {field.name: field.dataType for field in messages.schema.fields}
        rows = changes.withColumns(
            {
                "old": F.lit(None).cast(T.StructType([T.StructField(c, kinds[c]) for c in names])),
                "total": F.struct(*(F.lit(0).alias(c) for c in totals)),
            }
        )
    else:
        old = previous.select(*keys, F.struct(*names).alias("old"), F.struct(*totals).alias("total"))
        rows = old.join(changes, keys, "full")
    rows = rows.where(F.col("old").isNotNull() | F.col("new").isNotNull() | F.col("delta").isNotNull())
    row = F.when(newer_wins("old", "new", "updated_at"), F.col("new")).otherwise(F.col("old"))
    found = {**{c: f"delta.{c}" for c in deltas}, **({c: f"more.{c}" for c in more} if extra is not None else {})}
    done = rows.withColumns({"row": row, "touched": touched}).select(
        *keys,
        *(F.col(f"row.{c}").alias(c) for c in names if not c.startswith("updated_")),
        *(carried_total(f"total.{c}", found[delta]).alias(c) for c, delta in totals.items()),
        stamp(F.col("touched"), F.unix_millis(run_ts), F.col("row.updated_at")).alias("updated_at"),
        stamp(F.col("touched"), F.lit(dt), F.col("row.updated_date")).alias("updated_date"),
    )
    return cast_to_schema(done, table_schema(table))


def video_snapshot(
    dt: str,
    run_ts: Column,
    content: DataFrame,
    stats: DataFrame,
    replies: DataFrame,
    previous: DataFrame | None,
) -> DataFrame:
    """The video snapshot of ``dt``: newest attributes and running totals.

    A video that only got comments today and was never seen before is not added.
    """
    return _rolled(
        "dim_video_df", ["bvid"], VIDEO_TOTALS, content, require(stats, ("bvid",)), previous, dt,
        run_ts, replies,
    )


def comment_snapshot(
    dt: str, run_ts: Column, entities: DataFrame, stats: DataFrame, previous: DataFrame | None
) -> DataFrame:
    """The comment snapshot of ``dt`` by (rpid, oid), newest attributes and running totals."""
    keys = ["rpid", "oid"]
    known = require(stats, keys)
    return _rolled("dim_comment_df", keys, COMMENT_TOTALS, entities, known, previous, dt, run_ts)

"""Live dimensions: attribute and counter updates of the wide account, video and comment rows.

Each stream writes only the columns it knows into the table's change log; the folded read shows
for every column the newest value any stream or the nightly load has written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.casts import ms_to_text
from tidemark.functions.derive import (
    age_by_calendar,
    array_text,
    birth_year,
    is_official,
    json_text,
    reverse_key,
)
from tidemark.functions.labels import account_status_name, vip_type_name
from tidemark.functions.metrics import count_event, credit, net_delta
from tidemark.operators.rows import normalize_reply_key
from tidemark.plans.serving import (
    ACCOUNT_FAMILIES,
    COMMENT_FAMILIES,
    SECONDS,
    VIDEO_FAMILIES,
    comment_rowkey,
    families,
)
from tidemark.sources.changelog import upsert_columns
from tidemark.sources.streams import parse_messages
from tidemark.streaming import schemas
from tidemark.streaming.runs import start

# Video events that move a counter.
COUNTER_EVENTS = (
    "video_view", "video_like", "video_unlike", "video_coin", "video_favorite", "video_unfavorite",
    "video_share", "video_danmaku", "video_triple",
)
COMMENT_COUNTER_EVENTS = (
    "comment_like", "comment_unlike", "comment_dislike", "comment_undislike", "comment_reply",
)


def _topic(raw: DataFrame, topic: str) -> DataFrame:
    return raw.where(F.col("topic") == topic)


def account_attributes(raw: DataFrame, as_of: Column, run_ts: Column) -> DataFrame:
    """Profile messages as account columns; the version is the message's update time."""
    rows = parse_messages(_topic(raw, "app_user_profile"), schemas.PROFILE).where(F.col("mid").isNotNull())
    kind, tags = F.col("official_verify.type"), F.col("tags")
    created_day = ms_to_text("created_at", "yyyy-MM-dd")

    def known(path: str, default: bool) -> Column:
        return F.coalesce(F.col(path), F.lit(default))

    computed = {
        "age": age_by_calendar(F.col("birthday"), as_of),
        "birth_year": birth_year(F.col("birthday")),
        "vip_type_name": vip_type_name(F.col("vip_type")),
        "status_name": account_status_name(F.col("status")),
        "official_type": F.coalesce(kind, F.lit(-1)),
        "official_desc": F.col("official_verify.desc"),
        "is_official": is_official(kind),
        "privacy_show_fav": known("settings.privacy.show_fav", False),
        "privacy_show_history": known("settings.privacy.show_history", False),
        "push_comment": known("settings.push.comment", True),
        "push_like": known("settings.push.like", True),
        "push_at": known("settings.push.at", True),
        "theme": F.col("settings.theme"),
        "tags": array_text(tags),
        "tag_cnt": F.coalesce(F.size(tags), F.lit(0)),
        "primary_tag": F.get(tags, F.lit(0)),
        "created_at": ms_to_text("created_at", SECONDS),
        "updated_at": ms_to_text("updated_at", SECONDS),
        "account_age_days": F.date_diff(F.to_date(as_of), F.to_date(created_day)),
        "dw_create_time": F.date_format(run_ts, SECONDS),
    }
    layout = {name: columns for name, columns in ACCOUNT_FAMILIES.items() if name != "relation"}
    layout["status"] = "coins vip_type vip_type_name status status_name"
    return _pack(rows, reverse_key(F.col("mid")), layout, computed, F.col("updated_at"))


def _pack(
    rows: DataFrame, key: Column, layout: dict[str, str], computed: dict[str, Column], version: Column
) -> DataFrame:
    stamped = rows.withColumn("_version", version)
    packed = families(stamped, layout, computed)
    return stamped.select(
        key.alias("rowkey"),
        F.col("_version").alias("version"),
        *(
            F.struct(*(c.cast("string").alias(n) for n, c in columns.items())).alias(family)
            for family, columns in packed.items()
        ),
    )


def video_attributes(raw: DataFrame) -> DataFrame:
    """Video messages as video columns; the version is the message's update time."""
    rows = parse_messages(_topic(raw, "app_video_content"), schemas.VIDEO_CONTENT).where(F.col("bvid").isNotNull())

    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))

    def number(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(0))

    inner = ("upload_ip", "camera", "software", "resolution")
    counters = ("view", "danmaku", "reply", "favorite", "coin", "share", "like")
    computed = {
        "is_private": F.coalesce("is_private", F.lit(False)),
        "created_date": ms_to_text("created_at", "yyyy-MM-dd"),
        "updated_date": ms_to_text("updated_at", "yyyy-MM-dd"),
        "pub_date": ms_to_text("pubdate", "yyyy-MM-dd"),
        **{n: F.col(f"meta_info.{n}") for n in (*inner, "fps")},
        "meta_info": json_text(**{n: text(f"meta_info.{n}") for n in inner}, fps=number("meta_info.fps")),
        "stats_json": json_text(**{n: number(f"stats.{n}") for n in counters}),
    }
    layout = {name: columns for name, columns in VIDEO_FAMILIES.items() if name != "stats"}
    return _pack(rows, reverse_key(F.col("bvid")), layout, computed, F.col("updated_at"))


def comment_attributes(raw: DataFrame) -> DataFrame:
    """Comment messages as comment columns; the version is the message's update time."""
    rows = parse_messages(_topic(raw, "app_comment"), schemas.COMMENT).where(
        F.col("rpid").isNotNull() & F.col("oid").isNotNull()
    )
    computed = {
        "created_date": ms_to_text("created_at", "yyyy-MM-dd"),
        "updated_date": ms_to_text("updated_at", "yyyy-MM-dd"),
    }
    layout = {name: columns for name, columns in COMMENT_FAMILIES.items() if name != "stats"}
    key = comment_rowkey(F.col("rpid"), F.col("oid"))
    return _pack(rows, key, layout, computed, F.col("updated_at"))


def _day_totals(rows: DataFrame, arrival: str, start_time: str, keys: list[str], metrics: list[Column]) -> DataFrame:
    """Totals per arrival day and key; a finished day's state is dropped a minute after midnight."""
    timed = rows.withWatermark(arrival, "1 minute") if rows.isStreaming else rows
    return timed.groupBy(F.window(arrival, "1 day", startTime=start_time), *keys).agg(
        *metrics, F.unix_millis(F.max(arrival)).alias("version")
    )


def video_counters(raw: DataFrame, arrival: str = "arrival", start_time: str = "0 seconds") -> DataFrame:
    """Day totals per video by arrival time: bvid, window, the six counters, version."""
    rows = parse_messages(_topic(raw, "app_event_video"), schemas.VIDEO_EVENT, carry=(arrival,))
    counted = rows.where(F.col("bvid").isNotNull() & F.col("event_id").isin(*COUNTER_EVENTS))
    counted = counted.withColumn("coin_count", F.col("properties.coin_count"))
    return _day_totals(
        counted, arrival, start_time, ["bvid"],
        [
            count_event("video_view").alias("view_count"),
            count_event("video_danmaku").alias("danmaku_count"),
            net_delta(("video_favorite", "video_triple"), ("video_unfavorite",)).alias("favorite_count"),
            credit({"video_coin": F.coalesce(F.col("coin_count"), F.lit(1)), "video_triple": 2}).alias("coin_count"),
            count_event("video_share").alias("share_count"),
            net_delta(("video_like", "video_triple"), ("video_unlike",)).alias("like_count"),
        ],
    )


def video_reply_counters(
    raw: DataFrame, arrival: str = "arrival", start_time: str = "0 seconds", roots_only: bool = True
) -> DataFrame:
    """Day totals of new comments per video; root comments only by default."""
    rows = parse_messages(_topic(raw, "app_event_comment"), schemas.COMMENT_EVENT, carry=(arrival,))
    created = rows.where(
        F.col("oid").isNotNull() & (F.col("event_id") == "comment_create") & (F.col("properties.otype") == 1)
    ).withColumnRenamed("oid", "bvid")
    counted = F.count_if(F.col("rpid") == F.col("properties.root_rpid")) if roots_only else F.count("*")
    return _day_totals(created, arrival, start_time, ["bvid"], [counted.alias("reply_count")])


def comment_counters(raw: DataFrame, arrival: str = "arrival", start_time: str = "0 seconds") -> DataFrame:
    """Day totals per comment; a reply counts for the comment it answers."""
    rows = parse_messages(_topic(raw, "app_event_comment"), schemas.COMMENT_EVENT, carry=(arrival,))
    counted = (
        rows.where(F.col("rpid").isNotNull() & F.col("event_id").isin(*COMMENT_COUNTER_EVENTS))
        .withColumn("parent_rpid", F.col("properties.parent_rpid"))
        .withColumn("rpid", normalize_reply_key())
        .where(F.col("rpid").isNotNull())
    )
    return _day_totals(
        counted, arrival, start_time, ["rpid", "oid"],
        [
            net_delta(("comment_like",), ("comment_unlike",)).alias("like_count"),
            net_delta(("comment_dislike",), ("comment_undislike",)).alias("dislike_count"),
            count_event("comment_reply").alias("reply_count"),
        ],
    )


def counter_columns(totals: DataFrame, key: Column, base: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Counter totals as a ``stats`` family: the day's totals, on top of ``base`` when given.

    ``base`` is the last nightly snapshot; with it the written counter is the running grand total.
    """
    names = [c for c in totals.columns if c not in ("window", "version", *keys)]
    rows = totals
    if base is not None:
        old = base.select(*keys, *(F.col(n).alias(f"base_{n}") for n in names))
        rows = totals.join(old, list(keys), "left").withColumns(
            {n: F.col(n) + F.coalesce(F.col(f"base_{n}"), F.lit(0)) for n in names}
        )
    return rows.select(
        key.alias("rowkey"), "version", F.struct(*(F.col(n).cast("string").alias(n) for n in names)).alias("stats")
    )


def video_key() -> Column:
    return reverse_key(F.col("bvid"))


def comment_key() -> Column:
    return comment_rowkey(F.col("rpid"), F.col("oid"))


def start_upsert(
    changes: DataFrame, path: str, source: str, checkpoint: str, trigger: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Keep the columns of ``source`` current in the table at ``path``."""
    return start(changes, upsert_columns(path, source), checkpoint, trigger, mode)


def start_counters(
    totals: DataFrame, key: Column, path: str, source: str, checkpoint: str, trigger: str | None = "10 seconds",
    base: DataFrame | None = None, keys: tuple[str, ...] = (),
) -> StreamingQuery:
    """Keep the counters of ``source`` current; the snapshot is joined per refresh, to totals only."""
    upsert = upsert_columns(path, source)

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(counter_columns(batch, key, base, keys), batch_id)

    return start(totals, write, checkpoint, trigger, "update")

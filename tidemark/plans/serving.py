"""Loads from the warehouse into the serving tables: summary rows and wide keyed rows."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.derive import array_text, reverse_key
from tidemark.operators.serving import fresh_rows, pack_families, protect_keys
from tidemark.sources.daily import NIGHTLY, DailyTable
from tidemark.sources.wide import BUCKETS, WideTable

# The key columns of each serving summary table, and what stands for null in them.
SUMMARY_KEYS = {
    "dws_video_stats_account_di": ["mid", "dt"],
    "dws_video_stats_account_di_v2": ["bvid", "dt"],
    "dws_account_registry_source_di": (
        "dt sex level age birth_year vip_type status official_type theme primary_tag"
    ).split(),
    "dws_vip_order_source_di": (
        "dt order_status plan_id pay_method platform channel sex level official_type"
    ).split(),
    "dws_account_registry_source_from_event_di": (
        "dt platform channel register_type source_page os brand app_version network"
    ).split(),
}
SENTINELS = {
    "dws_video_stats_account_di": {"mid": 0},
    "dws_video_stats_account_di_v2": {"bvid": "", "mid": 0},
    "dws_account_registry_source_di": {
        "sex": "unknown", "level": -1, "age": -1, "birth_year": 0, "vip_type": 0, "status": 0,
        "official_type": -1, "theme": "", "primary_tag": "",
    },
    "dws_vip_order_source_di": {
        "order_status": "", "plan_id": "", "pay_method": "", "platform": "", "channel": "",
        "sex": "unknown", "level": -1, "official_type": -1,
    },
}
# The wide rows' families and their columns.
ACCOUNT_FAMILIES = {
    "basic": "mid nick_name sex face_url sign level birthday age birth_year",
    "status": "coins vip_type vip_type_name vip_expire status status_name",
    "official": "official_type official_desc is_official",
    "setting": "privacy_show_fav privacy_show_history push_comment push_like push_at theme",
    "tag": "tags tag_cnt primary_tag",
    "relation": (
        "following_list following_cnt follower_list follower_cnt mutual_follow_list "
        "mutual_follow_cnt blocking_list blocking_cnt blocked_by_list blocked_by_cnt "
        "following_chg follower_chg"
    ),
    "etl": "created_at updated_at account_age_days dw_create_time",
}
VIDEO_FAMILIES = {
    "basic": "bvid mid pubdate state attribute is_private",
    "content": "title cover desc_text duration category_id category_name",
    "stats": "view_count danmaku_count reply_count favorite_count coin_count share_count like_count",
    "meta": (
        "created_at updated_at created_date updated_date pub_date upload_ip camera software "
        "resolution fps audit_info meta_info stats_json"
    ),
}
COMMENT_FAMILIES = {
    "info": "rpid oid otype mid root parent state",
    "content": "content",
    "stats": "like_count dislike_count reply_count",
    "meta": "created_at updated_at created_date updated_date",
}
SECONDS = "yyyy-MM-dd HH:mm:ss"


def load_summary(table: str, summary: DataFrame, dt: str | None = None) -> DataFrame:
    """Summary rows ready for the serving table: key columns without nulls, one day or all days."""
    rows = summary if dt is None else summary.where(F.col("dt") == dt)
    return protect_keys(rows, SENTINELS[table])


def families(
    df: DataFrame, layout: dict[str, str], computed: dict[str, Column] | None = None
) -> dict[str, dict[str, Column]]:
    """Layout text to columns, taking ``computed`` where given; absent columns are left out."""
    computed = computed or {}
    known = set(df.columns)
    packed = {
        family: {
            name: computed[name] if name in computed else F.col(name)
            for name in names.split()
            if name in computed or name in known
        }
        for family, names in layout.items()
    }
    return {family: columns for family, columns in packed.items() if columns}


def comment_rowkey(rpid: Column, oid: Column) -> Column:
    """A comment is known by its id and its video, since an id alone may occur under two videos."""
    return F.concat(reverse_key(rpid), F.lit("_"), oid)


def account_rows(accounts: DataFrame, through: str) -> DataFrame:
    """Wide account rows of accounts last updated on or before ``through``."""
    fresh = fresh_rows(accounts, F.date_format("updated_at", "yyyy-MM-dd"), through)
    computed = {
        **{
            name: F.when(F.col(name).isNotNull() | (F.col(name.replace("_list", "_cnt")) == 0), array_text(F.col(name)))
            for name in ACCOUNT_FAMILIES["relation"].split()
            if name.endswith("_list")
        },
        "tags": array_text(F.col("tags")),
        **{name: F.date_format(name, SECONDS) for name in ("created_at", "updated_at", "dw_create_time")},
    }
    return pack_families(fresh, reverse_key(F.col("mid")), families(fresh, ACCOUNT_FAMILIES, computed))


def video_rows(videos: DataFrame, through: str) -> DataFrame:
    fresh = fresh_rows(videos, F.col("updated_date"), through)
    packed = families(fresh, VIDEO_FAMILIES, {"stats_json": F.col("stats")})
    return pack_families(fresh, reverse_key(F.col("bvid")), packed)


def comment_rows(comments: DataFrame, through: str) -> DataFrame:
    fresh = fresh_rows(comments, F.col("updated_date"), through)
    return pack_families(
        fresh, comment_rowkey(F.col("rpid"), F.col("oid")), families(fresh, COMMENT_FAMILIES)
    )


def night_version(dt: str) -> int:
    """The version of a night's wide rows: the last millisecond of the day that they stand for (UTC)."""
    midnight = datetime.combine(date.fromisoformat(dt) + timedelta(days=1), time(), timezone.utc)
    return int(midnight.timestamp()) * 1000 - 1


class Serving:
    """The serving tables under one folder, which nights load and streams keep current.

    Wide rows of a night are one more source of their table, with the night's version: columns that a
    stream has written since midnight stay, older ones give way. Summaries of a night replace their day.
    """

    WIDE = {"account": account_rows, "video": video_rows, "comment": comment_rows}

    def __init__(self, root: str, buckets: int = BUCKETS):
        self.root, self.buckets = root.rstrip("/"), buckets

    def wide(self, name: str) -> WideTable:
        return WideTable(f"{self.root}/wide_{name}", buckets=self.buckets)

    def summary(self, table: str) -> DailyTable:
        return DailyTable(f"{self.root}/{table}", SUMMARY_KEYS[table])

    def load_wide(self, name: str, snapshot: DataFrame, dt: str) -> None:
        """The snapshot of ``dt``: rows updated on or before that day. Loading a day again replaces it."""
        rows = self.WIDE[name](snapshot, dt).withColumn("version", F.lit(night_version(dt)).cast("bigint"))
        self.wide(name).load(rows, NIGHTLY, date.fromisoformat(dt).toordinal())

    def load_summary(self, table: str, summary: DataFrame, dt: str) -> None:
        self.summary(table).replace_day(load_summary(table, summary, dt), dt)

    def compact(self, spark: SparkSession, name: str, sources: list[str]) -> int:
        """Fold what streams and nights have written into the base of a wide table; run it as often as its
        tail should stay short."""
        return self.wide(name).compact(spark, [*sources, NIGHTLY])

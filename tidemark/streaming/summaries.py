"""Live summaries: running totals of the current day or hour, refreshed every few seconds.

A summary is kept as totals per window, key and, where a distinct count is asked for, per counted
value. That makes the distinct count a row count when read, needs no set in any state row, and
spreads a hot key's state over its values. The same code runs on stored events.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.labels import ORDER_STATUS_BY_EVENT, event_to_status
from tidemark.functions.metrics import interaction_metrics
from tidemark.operators.enrich import left_enrich
from tidemark.operators.rows import placeholders
from tidemark.plans.summaries import UPLOADER_COLUMNS, UPLOADER_TOTALS, VIDEO_COLUMNS, VIDEO_RENAMES
from tidemark.sources.changelog import read_latest, upsert_versioned
from tidemark.sources.streams import parse_messages, with_event_time
from tidemark.streaming import schemas
from tidemark.streaming.runs import start

# Events that count, refresh steps, window sizes and what stands in for columns that
# only the nightly run can fill.
COUNTED_VIDEO_EVENTS = (
    "video_view", "video_play_heartbeat", "video_like", "video_unlike", "video_coin", "video_favorite",
    "video_unfavorite", "video_share", "video_danmaku", "video_triple",
)
UPLOADER_BLANKS = {
    "nick_name": ("string", None), "sex": ("string", None), "level": ("int", None),
    "vip_type": ("int", None), "vip_type_name": ("string", None), "official_type": ("int", None),
    "official_desc": ("string", None), "is_official": ("boolean", None),
    "follower_cnt": ("int", None), "following_cnt": ("int", None),
    "total_view_user_count": ("bigint", None), "avg_play_duration_sec": ("int", None),
}
VIDEO_BLANKS = {"view_user_count": ("bigint", None), "avg_play_duration_sec": ("int", None)}
BUYER_BLANKS = {
    "plan_duration_days": ("int", 0), "from_page": ("string", "unknown"), "sex": ("string", "unknown"),
    "age": ("int", -1), "birth_year": ("int", -1), "level": ("int", -1), "official_type": ("int", -1),
    "is_official": ("boolean", False), "primary_tag": ("string", "unknown"),
    "account_age_days": ("int", -1), "follower_cnt": ("int", -1),
}
REGISTRY_BLANKS = {
    "sex": ("string", "unknown"), "level": ("int", -1), "age": ("int", -1), "birth_year": ("int", -1),
    "vip_type": ("int", -1), "vip_type_name": ("string", "unknown"), "status": ("int", -1),
    "status_name": ("string", "unknown"), "official_type": ("int", -1), "is_official": ("boolean", False),
    "theme": ("string", "unknown"), "primary_tag": ("string", "unknown"),
}


@dataclass(frozen=True)
class LiveSummary:
    """What a live summary counts and how its rows look."""

    name: str
    topic: str
    schema: str
    rows: Callable[[DataFrame], DataFrame]
    keys: list[str]
    metrics: Callable[[], list[Column]]
    names: tuple[str, ...]
    size: str = "1 day"
    step: str = "15 seconds"
    distinct: tuple[str, str] | None = None
    maxima: tuple[str, ...] = ()
    blanks: dict[str, tuple[str, object]] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)
    casts: dict[str, str] = field(default_factory=dict)
    day_pattern: str = "yyyy-MM-dd"

    @property
    def state_keys(self) -> list[str]:
        return [*self.keys, *([self.distinct[0]] if self.distinct else [])]

    def parse(self, raw: DataFrame, delay: str = "5 seconds") -> DataFrame:
        """Messages of the topic as the rows that count, with event time."""
        messages = parse_messages(raw.where(F.col("topic") == self.topic), self.schema)
        return self.rows(with_event_time(messages, delay=delay))

    def totals(self, events: DataFrame, start_time: str = "0 seconds") -> DataFrame:
        """Running totals per window and key; in update mode each change gives the new total."""
        return (
            events.groupBy(F.window("event_time", self.size, startTime=start_time), *self.state_keys)
            .agg(*self.metrics())
            .select(
                F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"),
                *self.state_keys,
                *self.names,
            )
        )

    def view(
        self, totals: DataFrame, run_ts: Column, stamp_end: bool = False
    ) -> DataFrame:
        """Summary rows out of the newest totals.

        The day is that of the window's start; ``stamp_end`` takes the window's end, which puts a
        full day's total on the next day.
        """
        names = list(self.names)
        rows = totals
        if self.distinct:
            value, out = self.distinct
            rows = totals.groupBy("window_start", "window_end", *self.keys).agg(
                *((F.max(n) if n in self.maxima else F.sum(n)).alias(n) for n in names),
                F.count(value).alias(out),
            )
            names = [*names, out]
        bound = F.col("window_end" if stamp_end else "window_start")
        return rows.select(
            *self.keys,
            *(
                F.col(n).try_cast(self.casts[n]).alias(n)
                if n in self.casts
                else F.col(n).alias(self.renames.get(n, n))
                for n in names
            ),
            *placeholders(self.blanks),
            F.date_format(bound, self.day_pattern).alias("dt"),
            run_ts.alias("dw_create_time"),
        )

    def start(
        self, raw: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
        start_time: str = "0 seconds",
    ) -> StreamingQuery:
        """Keep the totals current under ``path``; ``trigger`` is usually :attr:`step`."""
        totals = self.totals(self.parse(raw), start_time)
        return start(totals, upsert_versioned(path, self.name), checkpoint, trigger)

    def read(self, spark: SparkSession, path: str, run_ts: Column, stamp_end: bool = False) -> DataFrame:
        """What the stream has reached: the newest totals per key as summary rows."""
        keys = ["window_start", "window_end", *self.state_keys]
        return self.view(read_latest(spark, path, keys), run_ts, stamp_end)


VIDEO_METRICS = (
    "view_count", "total_play_duration_sec", "like_count_delta", "unlike_count_delta", "net_like_delta",
    "coin_count_delta", "coin_total_delta", "favorite_count_delta", "unfavorite_count_delta",
    "net_favorite_delta", "share_count", "danmaku_count", "triple_count",
)
ORDER_MONEY = ("original_price", "final_price", "discount_amount")


def _video_rows(events: DataFrame) -> DataFrame:
    counted = events.where(
        F.col("mid").isNotNull() & F.col("bvid").isNotNull() & F.col("event_id").isin(*COUNTED_VIDEO_EVENTS)
    )
    return counted.withColumn("coin_count", F.col("properties.coin_count"))


def _video_metrics() -> list[Column]:
    return interaction_metrics(triple_counts=True)


def _order_rows(events: DataFrame) -> DataFrame:
    counted = events.where(F.col("event_id").isin(*ORDER_STATUS_BY_EVENT) & F.col("mid").isNotNull())

    def text(path: str, default: str) -> Column:
        return F.coalesce(F.col(path), F.lit(default))

    return counted.select(
        "event_time",
        "mid",
        event_to_status(F.col("event_id")).alias("order_status"),
        *(text(f"properties.{n}", "unknown").alias(n) for n in ("plan_id", "plan_name", "pay_method")),
        *(text(f"app_context.{n}", "unknown").alias(n) for n in ("platform", "channel")),
        F.coalesce("properties.current_vip_type", F.lit(0)).alias("current_vip_type"),
        *(text(f"properties.{n}", "").alias(n) for n in ("coupon_id", "error_code", "cancel_stage")),
        *(
            F.coalesce(f"properties.{n}", F.lit(0)).alias(n)
            for n in ("original_price", "final_price", "discount_amount", "pay_duration_sec")
        ),
    )


def _order_metrics() -> list[Column]:
    return [
        F.count("*").alias("order_cnt"),
        *(F.sum(n).alias(n) for n in ORDER_MONEY),
        F.max("pay_duration_sec").alias("pay_duration_sec"),
    ]


def _registrations(events: DataFrame) -> DataFrame:
    return events.where((F.col("event_id") == "account_register") & F.col("mid").isNotNull())


def _registration_sources(events: DataFrame) -> DataFrame:
    def text(*paths: str) -> Column:
        return F.coalesce(*(F.col(p) for p in paths), F.lit("unknown"))

    return _registrations(events).select(
        "event_time",
        F.col("device_info.device_id").alias("device_id"),
        text("app_context.platform").alias("platform"),
        text("properties.channel", "app_context.channel").alias("channel"),
        text("properties.register_type").alias("register_type"),
        text("properties.source_page").alias("source_page"),
        text("device_info.os").alias("os"),
        text("device_info.brand").alias("brand"),
        text("app_context.app_version").alias("app_version"),
        text("device_info.network").alias("network"),
    )


def _new_accounts() -> list[Column]:
    return [F.count("*").alias("new_account_cnt")]


# Metrics per viewer ("mid" is the acting account), with the number of videos touched.
UPLOADER = LiveSummary(
    name="uploader", topic="app_event_video", schema=schemas.VIDEO_EVENT, rows=_video_rows,
    keys=["mid"], metrics=_video_metrics, names=VIDEO_METRICS, distinct=("bvid", "video_cnt"), blanks=UPLOADER_BLANKS,
    renames={metric: total for total, metric in UPLOADER_TOTALS.items()},
)
VIDEO = LiveSummary(
    name="video", topic="app_event_video", schema=schemas.VIDEO_EVENT, rows=_video_rows,
    keys=["bvid", "mid"], metrics=_video_metrics, names=VIDEO_METRICS, blanks=VIDEO_BLANKS, renames=VIDEO_RENAMES,
)
VIP_ORDER = LiveSummary(
    name="vip_order", topic="app_event_vip", schema=schemas.VIP_EVENT, rows=_order_rows,
    keys=(
        "order_status plan_id plan_name pay_method platform channel current_vip_type coupon_id error_code "
        "cancel_stage"
    ).split(),
    metrics=_order_metrics, names=("order_cnt", *ORDER_MONEY, "pay_duration_sec"), distinct=("mid", "order_user_cnt"), maxima=("pay_duration_sec",),
    blanks=BUYER_BLANKS, casts={n: "decimal(12,2)" for n in ORDER_MONEY},
)
REGISTRATION = LiveSummary(
    name="registration", topic="app_event_account", schema=schemas.ACCOUNT_EVENT, rows=_registrations,
    keys=[], metrics=_new_accounts, names=("new_account_cnt",), step="60 seconds", blanks=REGISTRY_BLANKS,
)
REGISTRATION_SOURCE = LiveSummary(
    name="registration_source", topic="app_event_account", schema=schemas.ACCOUNT_EVENT,
    rows=_registration_sources,
    keys="platform channel register_type source_page os brand app_version network".split(),
    metrics=_new_accounts, names=("new_account_cnt",), size="1 hour", distinct=("device_id", "new_device_cnt"),
    day_pattern="yyyy-MM-dd HH:00:00",
)


def enrich_video_view(view: DataFrame, videos: DataFrame, accounts: DataFrame) -> DataFrame:
    """Video and account columns from the current wide rows, looked up for summary rows.

    The lookup is done on totals instead of on events, so a video with many events is looked up
    once per refresh. ``videos`` and ``accounts`` are flat: see the lookups' column maps.
    """
    # The acting account's columns are shown; the video's own owner is not part of the row.
    described = left_enrich(view, videos, ["bvid"], [c for c in VIDEO_COLUMNS if c != "mid"])
    return left_enrich(described, accounts, ["mid"], UPLOADER_COLUMNS)

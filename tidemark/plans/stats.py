"""Daily metrics per video and per comment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import (
    count_event,
    distinct_for,
    interaction_metrics,
    net_delta,
    whole_ratio,
)
from tidemark.operators.rows import require

# Which comment event each counter counts.
COMMENT_COUNTERS = {
    "like_count_delta": "comment_like",
    "unlike_count_delta": "comment_unlike",
    "dislike_count_delta": "comment_dislike",
    "undislike_count_delta": "comment_undislike",
    "reply_count_delta": "comment_reply",
    "report_count": "comment_report",
}
VIDEO_STATS_INPUT = ["event_id", "mid", "bvid", "coin_count"]
COMMENT_STATS_INPUT = ["event_id", "oid", "rpid", "parent_rpid"]


def video_stats(actions: DataFrame, triple_counts: bool = False) -> DataFrame:
    """Metrics per day and video.

    The distinct viewer count makes Spark reduce by (video, viewer) first, so a video with a
    third of all events is spread over its viewers before anything meets per video.
    """
    metrics = require(actions, not_null=("bvid",)).groupBy("dt", "bvid").agg(
        *interaction_metrics(triple_counts),
        distinct_for("video_view", "mid").alias("view_user_count"),
    )
    average = whole_ratio(F.col("total_play_duration_sec"), F.col("view_user_count"))
    return metrics.withColumn("avg_play_duration_sec", average)


def comment_stats(actions: DataFrame, credit_parent: bool = False) -> DataFrame:
    """Metrics per day and comment (rpid, oid).

    A reply counts for the comment that carries the event; with ``credit_parent`` for its parent.
    """
    rows = actions
    if credit_parent:
        is_reply = F.col("event_id") == "comment_reply"
        rows = rows.withColumn("rpid", F.when(is_reply, F.col("parent_rpid")).otherwise(F.col("rpid")))
    return require(rows, not_null=("rpid",)).groupBy("dt", "rpid", "oid").agg(
        *(count_event(event).alias(name) for name, event in COMMENT_COUNTERS.items()),
        net_delta(("comment_like",), ("comment_unlike",)).alias("net_like_delta"),
        net_delta(("comment_dislike",), ("comment_undislike",)).alias("net_dislike_delta"),
    )


def reply_counts(actions: DataFrame, roots_only: bool = False) -> DataFrame:
    """New comments per day and video; ``roots_only`` counts those that are their own root."""
    created = actions.where((F.col("event_id") == "comment_create") & F.col("oid").isNotNull())
    counted = F.count_if(F.col("rpid") == F.col("root_rpid")) if roots_only else F.count("*")
    return created.groupBy("dt", F.col("oid").alias("bvid")).agg(counted.alias("reply_delta"))

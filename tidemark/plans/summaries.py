"""Daily summaries for analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import whole_ratio
from tidemark.operators.enrich import inner_enrich, left_enrich
from tidemark.operators.snapshots import new_keys

# Summary dimensions and metrics in table order.
REGISTRY_DIMS = (
    "sex level age birth_year vip_type vip_type_name status status_name official_type is_official "
    "theme primary_tag"
).split()
UPLOADER_COLUMNS = (
    "nick_name sex level vip_type vip_type_name official_type official_desc is_official follower_cnt "
    "following_cnt"
).split()
VIDEO_COLUMNS = "title duration pubdate pub_date category_id category_name mid".split()
ORDER_DIMS = (
    "order_status plan_id plan_name plan_duration_days pay_method platform channel from_page "
    "current_vip_type coupon_id error_code cancel_stage"
).split()
BUYER_DIMS = (
    "sex age birth_year level official_type is_official primary_tag account_age_days follower_cnt"
).split()
ORDER_AMOUNTS = "original_price final_price discount_amount pay_duration_sec".split()
UPLOADER_TOTALS = {
    "total_view_count": "view_count",
    "total_view_user_count": "view_user_count",
    "total_play_duration_sec": "total_play_duration_sec",
    "total_like_delta": "like_count_delta",
    "total_unlike_delta": "unlike_count_delta",
    "total_net_like_delta": "net_like_delta",
    "total_coin_count_delta": "coin_count_delta",
    "total_coin_total_delta": "coin_total_delta",
    "total_favorite_delta": "favorite_count_delta",
    "total_unfavorite_delta": "unfavorite_count_delta",
    "total_net_favorite_delta": "net_favorite_delta",
    "total_share_count": "share_count",
    "total_danmaku_count": "danmaku_count",
    "total_triple_count": "triple_count",
}
VIDEO_RENAMES = {
    "like_count_delta": "like_delta",
    "unlike_count_delta": "unlike_delta",
    "favorite_count_delta": "favorite_delta",
    "unfavorite_count_delta": "unfavorite_delta",
}


def registry_source(today: DataFrame, before: DataFrame, run_ts: Column) -> DataFrame:
    """New accounts (today's snapshot without yesterday's) counted by their attributes.

    Only the grouping columns are read from the snapshot. Null is a group of its own.
    """
    fresh = new_keys(today.select("mid", *REGISTRY_DIMS), before, ["mid"])
    return (
        fresh.groupBy(*REGISTRY_DIMS)
        .agg(F.count("*").alias("new_account_cnt"))
        .withColumn("dw_create_time", run_ts)
    )


def uploader_summary(
    stats: DataFrame, videos: DataFrame, accounts: DataFrame, run_ts: Column
) -> DataFrame:
    """Video metrics per uploader and day.

    Metrics are summed before accounts are joined, so the second join sees one row per uploader.
    ``total_view_user_count`` adds up per-video viewer counts: a viewer of two videos counts twice.
    """
    day = [c for c in ("dt",) if c in stats.columns]
    owned = inner_enrich(stats, videos, ["bvid"], ["mid"])
    totals = owned.groupBy(*day, "mid").agg(
        # One row per video and day, so counting rows counts videos.
        F.count("bvid").alias("video_cnt"),
        *(F.sum(metric).alias(total) for total, metric in UPLOADER_TOTALS.items()),
    )
    average = whole_ratio(F.col("total_play_duration_sec"), F.col("total_view_user_count"))
    known = accounts.withColumn("owner", F.col("mid"))
    return (
        left_enrich(totals.withColumn("avg_play_duration_sec", average), known, ["mid"], ["owner", *UPLOADER_COLUMNS])
        # The reported id is the dimension's: null for an uploader that is not an account.
        .withColumn("mid", F.col("owner"))
        .drop("owner")
        .withColumn("dw_create_time", run_ts)
    )


def exact_uploader_viewers(actions: DataFrame, videos: DataFrame) -> DataFrame:
    """Distinct viewers per uploader and day, each viewer once however many videos were watched."""
    viewed = actions.where(F.col("event_id") == "video_view").select("dt", "bvid", F.col("mid").alias("viewer"))
    owned = inner_enrich(viewed.distinct(), videos, ["bvid"], ["mid"])
    return owned.groupBy("dt", "mid").agg(F.count_distinct("viewer").alias("view_user_count"))


def video_summary(stats: DataFrame, videos: DataFrame, accounts: DataFrame, run_ts: Column) -> DataFrame:
    """Video metrics with video and uploader columns, one row per video and day.

    Rows of a prolific uploader meet in one key of the second join; AQE splits that partition.
    """
    known = inner_enrich(stats, videos, ["bvid"], VIDEO_COLUMNS)
    return (
        left_enrich(known, accounts, ["mid"], UPLOADER_COLUMNS)
        .withColumnsRenamed(VIDEO_RENAMES)
        .withColumn("dw_create_time", run_ts)
    )


def order_source(orders: DataFrame, accounts: DataFrame, run_ts: Column) -> DataFrame:
    """Orders counted by order and buyer attributes.

    Orders are first reduced per buyer and order attributes, then joined, then reduced again:
    an account behind a third of all orders reaches the join as a few rows.
    """
    day = [c for c in ("dt",) if c in orders.columns]
    zero = F.lit(0)
    per_buyer = orders.groupBy(*day, "mid", *ORDER_DIMS).agg(
        F.count("*").alias("order_cnt"),
        F.count("mid").alias("order_user_cnt"),
        *(F.max(F.coalesce(F.col(amount), zero)).alias(amount) for amount in ORDER_AMOUNTS),
    )
    return (
        left_enrich(per_buyer, accounts, ["mid"], BUYER_DIMS)
        .groupBy(*day, *ORDER_DIMS, *BUYER_DIMS)
        .agg(
            F.sum("order_cnt").alias("order_cnt"),
            F.sum("order_user_cnt").alias("order_user_cnt"),
            *(F.max(amount).alias(amount) for amount in ORDER_AMOUNTS),
        )
        .withColumn("dw_create_time", run_ts)
    )

"""The nightly run: every table of one day, in order, each written before it is read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.relations import relation_rollforward
from tidemark.plans import detail, dims, stats, summaries
from tidemark.plans.serving import Serving
from tidemark.sources.tables import Tables


def run_day(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    dt: str,
    run_ts: str,
    bootstrap: bool = False,
    expire_unit: str = "ms",
    carry_forward: bool = False,
    serving: Serving | None = None,
    buckets: int | None = None,
) -> Tables:
    """Compute all tables of ``dt`` under ``root``; running it again replaces the same partitions.

    Written partitions are the boundaries between jobs: they cut lineage, and a lost executor
    costs at most the tasks of the table being written. The day before must exist unless
    ``bootstrap`` is set. With ``serving``, the day's summaries and snapshots are then loaded there. With
    ``buckets``, video and comment snapshots are stored so that the next day does not shuffle them.
    """
    tables = Tables(spark, root, buckets)
    now = F.lit(run_ts).cast("timestamp")

    def day(df: DataFrame) -> DataFrame:
        return df.drop("dt")

    def stored(name: str) -> DataFrame:
        return tables.scan_snapshot(name, dt).withColumn("dt", F.lit(dt))

    before = {
        name: tables.previous_snapshot(name, dt, bootstrap)
        for name in ("dim_account_df", "dim_account_relation_df", "dim_video_df", "dim_comment_df")
    }
    tables.overwrite_partition(day(detail.account_actions(raw, dt)), "dwd_action_account_di", dt)
    tables.overwrite_partition(day(detail.comment_actions(raw, dt)), "dwd_action_comment_di", dt)
    tables.overwrite_partition(day(detail.video_actions(raw, dt)), "dwd_action_video_di", dt)
    tables.overwrite_partition(day(detail.vip_orders(raw, dt)), "dwd_order_vip_di", dt)

    video_actions, comment_actions = stored("dwd_action_video_di"), stored("dwd_action_comment_di")
    tables.overwrite_partition(day(stats.video_stats(video_actions)), "dwd_stats_video_di", dt)
    tables.overwrite_partition(day(stats.comment_stats(comment_actions)), "dwd_stats_comment_di", dt)

    pairs = relation_rollforward(before["dim_account_relation_df"], stored("dwd_action_account_di"))
    tables.overwrite_partition(pairs, "dim_account_relation_df", dt)
    lists = dims.large_account_lists(tables.scan_snapshot("dim_account_relation_df", dt))
    tables.overwrite_partition(lists, "dim_account_list_df", dt)
    tables.overwrite_partition(
        dims.account_snapshot(
            dt,
            now,
            dims.profiles(raw, dt),
            tables.scan_snapshot("dim_account_relation_df", dt),
            stored("dwd_order_vip_di"),
            before["dim_account_df"],
            expire_unit,
            carry_forward,
        ),
        "dim_account_df",
        dt,
    )
    tables.overwrite_partition(
        dims.video_snapshot(
            dt,
            now,
            dims.video_content(raw, dt),
            stored("dwd_stats_video_di"),
            stats.reply_counts(comment_actions),
            before["dim_video_df"],
        ),
        "dim_video_df",
        dt,
    )
    tables.overwrite_partition(
        dims.comment_snapshot(
            dt, now, dims.comment_entities(raw, dt), stored("dwd_stats_comment_di"), before["dim_comment_df"]
        ),
        "dim_comment_df",
        dt,
    )

    accounts, videos = tables.scan_snapshot("dim_account_df", dt), tables.scan_snapshot("dim_video_df", dt)
    video_stats, orders = stored("dwd_stats_video_di"), stored("dwd_order_vip_di")
    old_accounts = before["dim_account_df"]
    fresh_against = accounts.limit(0) if old_accounts is None else old_accounts
    for name, summary in {
        "dws_account_registry_source_di": summaries.registry_source(accounts, fresh_against, now),
        "dws_video_stats_account_di": summaries.uploader_summary(video_stats, videos, accounts, now),
        "dws_video_stats_account_di_v2": summaries.video_summary(video_stats, videos, accounts, now),
        "dws_vip_order_source_di": summaries.order_source(orders, accounts, now),
    }.items():
        tables.overwrite_partition(summary.drop("dt"), name, dt)
        if serving:
            serving.load_summary(name, stored(name), dt)
    if serving:
        for name, table in {"account": "dim_account_df", "video": "dim_video_df", "comment": "dim_comment_df"}.items():
            serving.load_wide(name, tables.scan_snapshot(table, dt), dt)
    return tables

"""Looking up wide rows for streams: a left join to what the table holds at each refresh.

A refresh reads the key buckets that its rows fall into, see :meth:`tidemark.sources.wide.WideTable.read_for`;
what a row was first described with stays, as readers take the first value of looked-up columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.derive import reverse_key
from tidemark.operators.serving import unpack_families
from tidemark.sources.changelog import read_versions
from tidemark.streaming.runs import start

# Looked-up columns, their place in the wide row, their type.
ACCOUNT_COLUMNS = {
    "nick_name": ("basic.nick_name", "string"),
    "sex": ("basic.sex", "string"),
    "level": ("basic.level", "int"),
    "vip_type": ("status.vip_type", "int"),
    "vip_type_name": ("status.vip_type_name", "string"),
    "official_type": ("official.official_type", "int"),
    "official_desc": ("official.official_desc", "string"),
    "is_official": ("official.is_official", "boolean"),
    "follower_cnt": ("relation.follower_cnt", "int"),
    "following_cnt": ("relation.following_cnt", "int"),
}
VIDEO_COLUMNS = {
    "title": ("content.title", "string"),
    "duration": ("content.duration", "int"),
    "pubdate": ("basic.pubdate", "bigint"),
    "pub_date": ("meta.pub_date", "string"),
    "category_id": ("content.category_id", "int"),
    "category_name": ("content.category_name", "string"),
}


def lookup_join(rows: DataFrame, wide: DataFrame, key: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Typed columns of the wide row whose key is ``key`` reversed; nulls where there is none.

    Works on a stream too: the wide rows are then read again for every micro-batch. Rows of one key
    may be many, so the join is left to AQE; the wide side is cut to the wanted columns first.
    """
    found = unpack_families(wide, columns).withColumnRenamed("rowkey", "_rowkey")
    return rows.join(found, reverse_key(F.col(key)) == F.col("_rowkey"), "left").drop("_rowkey")


def start_enriched(
    totals: DataFrame,
    videos_for: Callable[[DataFrame], DataFrame],
    accounts_for: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Running totals by video and account with looked-up columns, each refresh with current ones.

    The lookup is done on the totals that changed, not on the events behind them. ``videos_for`` and
    ``accounts_for`` are given the refresh's row keys (``rowkey``) and return wide rows that hold at least
    theirs.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        changed = batch.persist()
        try:
            videos = videos_for(changed.select(reverse_key(F.col("bvid")).alias("rowkey")))
            accounts = accounts_for(changed.select(reverse_key(F.col("mid")).alias("rowkey")))
            described = lookup_join(changed, videos, "bvid", VIDEO_COLUMNS)
            sink(lookup_join(described, accounts, "mid", ACCOUNT_COLUMNS), batch_id)
        finally:
            changed.unpersist()

    return start(totals, write, checkpoint, trigger)


def read_first_described(spark: SparkSession, path: str, keys: list[str], described: list[str]) -> DataFrame:
    """The newest totals per key, with the first value of each described column that was found for it."""
    versions = read_versions(spark, path)
    rest = [c for c in versions.columns if c not in (*keys, *described, "source", "batch_id")]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("newest")
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("batch_id"))).alias(c) for c in described]
    return versions.groupBy(*keys).agg(newest, *first).select(*keys, *described, "newest.*")

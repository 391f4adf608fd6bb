"""Day-partitioned tables: reading one day, reading the day before, replacing one day."""

from __future__ import annotations

import zlib
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import DDL, cast_to_schema, table_schema


class MissingSnapshot(RuntimeError):
    """The snapshot of the day before is not there, so a day cannot be rolled forward."""


def day_before(dt: str) -> str:
    return (date.fromisoformat(dt) - timedelta(days=1)).isoformat()


def days_back(dt: str, count: int) -> list[str]:
    """``dt`` and the ``count`` days before it, oldest first."""
    last = date.fromisoformat(dt)
    return [(last - timedelta(days=n)).isoformat() for n in range(count, -1, -1)]


# The keys of the snapshots that are rolled forward by one join.
ROLLED_KEYS = {"dim_video_df": ["bvid"], "dim_comment_df": ["rpid", "oid"]}


class Tables:
    """The warehouse folder: one Parquet folder per table, partitioned by ``dt``.

    With ``buckets``, days of the snapshots in ``ROLLED_KEYS`` are written bucketed and sorted by their keys: the
    next day's join then reads yesterday's snapshot where it lies, and only the day's changes are shuffled.
    Choose as many as the session has shuffle partitions, or more. A folder notes its number of buckets;
    days written without, or with another number, are read as plain folders.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.buckets = spark, buckets
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        schema = T.StructType([*table_schema(name).fields, T.StructField("dt", T.StringType())])
        return self.spark.read.schema(schema).parquet(self.path(name))

    def scan_snapshot(self, name: str, dt: str) -> DataFrame:
        """One day of a table; the literal condition prunes to one partition folder."""
        if self.buckets and name in ROLLED_KEYS and self._exists(self._mark(name, dt)):
            return self.spark.table(self._register(name, dt))
        return self.read(name).where(F.col("dt") == dt).drop("dt")

    def has_day(self, name: str, dt: str) -> bool:
        """Whether the day's partition is there and committed; an empty day counts as present.

        A write that broke off while its files were being published leaves its temporary folder
        behind, and such a day counts as missing.
        """
        folder = f"{self.path(name)}/dt={dt}"
        return self._exists(folder) and not self._exists(f"{folder}/_temporary")

    def _mark(self, name: str, dt: str) -> str:
        return f"{self.path(name)}/dt={dt}/_buckets-{self.buckets}"

    def _table(self, name: str, dt: str) -> str:
        """The day's name in the session's catalog, through which Spark learns of its buckets."""
        return f"{name}_{dt.replace('-', '')}_{zlib.crc32(self.root.encode()):08x}"

    def _register(self, name: str, dt: str) -> str:
        keys, table = ", ".join(ROLLED_KEYS[name]), self._table(name, dt)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({DDL[name]}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path(name)}/dt={dt}'"
        )
        return table

    def _overwrite_bucketed(self, body: DataFrame, name: str, dt: str) -> None:
        """The rows come out of the roll-forward's join on the same keys, so each task holds whole buckets."""
        keys, folder, table = ROLLED_KEYS[name], f"{self.path(name)}/dt={dt}", self._table(name, dt)
        writer = body.write.format("parquet").mode("overwrite").bucketBy(self.buckets, *keys).sortBy(*keys)
        writer.option("path", folder).saveAsTable(table)
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(self._mark(name, dt))
        mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(mark, True).close()

    def _exists(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return bool(system.exists(folder))

    def previous_snapshot(self, name: str, dt: str, bootstrap: bool = False) -> DataFrame | None:
        """The day before ``dt``; None with ``bootstrap``, an error when it is missing otherwise."""
        before = day_before(dt)
        if self.has_day(name, before):
            return self.scan_snapshot(name, before)
        if bootstrap:
            return None
        raise MissingSnapshot(f"{name} has no dt={before}; run that day first or bootstrap")

    def overwrite_partition(self, df: DataFrame, name: str, dt: str) -> None:
        """Replace one day; running it again gives the same folder.

        The day's folder is the write target itself, so no other day is touched whatever the
        session's overwrite mode. ``rebalance`` lets AQE even out file sizes: it splits a
        hot partition and joins small ones instead of writing one file per shuffle partition.
        """
        body = cast_to_schema(df, table_schema(name))
        if self.buckets and name in ROLLED_KEYS:
            self._overwrite_bucketed(body, name, dt)
            return
        body.hint("rebalance").write.mode("overwrite").parquet(f"{self.path(name)}/dt={dt}")

    def overwrite_days(self, df: DataFrame, name: str) -> None:
        """Replace every day found in ``df`` (a backfill), leaving the other days alone."""
        body = cast_to_schema(df, table_schema(name), extra=("dt",))
        (
            body.hint("rebalance", "dt")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("dt")
            .parquet(self.path(name))
        )


__all__ = ["MissingSnapshot", "ROLLED_KEYS", "Tables", "day_before", "days_back"]

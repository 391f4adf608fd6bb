"""Live counters handed over at midnight: day totals on top of the newest nightly snapshot.

A stream writes the totals of each arrival day on their own. What a counter stands at is worked out where it
is read: the snapshot's value plus the live totals of all days after the snapshot's day. So it makes no
difference whether a day's snapshot is there at midnight, hours later or not at all, and no day counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.snapshots import latest_by_key
from tidemark.streaming.runs import start


class DayCounters:
    """Totals ``names`` per ``keys`` and day in the folder ``path``, as ``streaming.dims`` counts them."""

    def __init__(self, path: str, keys: list[str], names: list[str]):
        self.path, self.keys, self.names = path.rstrip("/"), keys, names

    def write(self, totals: DataFrame, batch_id: int) -> None:
        """The changed totals of one micro-batch; the same batch id replaces itself."""
        rows = totals.select(
            *self.keys, *self.names, "version", F.date_format("window.start", "yyyy-MM-dd").alias("day")
        )
        rows.write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/batch_id={batch_id}")

    def start(self, totals: DataFrame, checkpoint: str, trigger: str | None = "10 seconds") -> StreamingQuery:
        return start(totals, self.write, checkpoint, trigger, "update")

    def since(self, spark: SparkSession, after: str) -> DataFrame:
        """Totals per key over the days after ``after``; only those days' folders are read."""
        log = spark.read.option("basePath", self.path).parquet(f"{self.path}/batch_id=*")
        days = log.where(F.col("day").cast("string") > after)
        newest = latest_by_key(days, [*self.keys, "day"], ["batch_id"])
        return newest.groupBy(*self.keys).agg(*(F.sum(n).cast("bigint").alias(n) for n in self.names))

    def current(self, snapshot: DataFrame, day: str) -> DataFrame:
        """The counters of the keys touched since the snapshot of ``day``, which holds the same names."""
        live = self.since(snapshot.sparkSession, day)
        old = snapshot.select(*self.keys, *(F.col(n).alias(f"old_{n}") for n in self.names))
        joined = live.join(old, self.keys, "left")
        return joined.select(
            *self.keys, *((F.col(n) + F.coalesce(F.col(f"old_{n}"), F.lit(0))).alias(n) for n in self.names)
        )

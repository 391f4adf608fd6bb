"""Summary tables that nights replace by the day and streams update by the key.

``log/source=/batch_id=`` holds versioned rows; a night's load is the batch of its day, so that loading a day
again replaces what the first load wrote, with the keys that it no longer has. ``loads/batch_id=`` notes
each night's version: rows of that day from other sources count only if they are newer.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.serving import latest_version
from tidemark.sources.changelog import read_versions, upsert_versioned, write_batch

NIGHTLY = "nightly"


class DailyTable:
    """Rows by ``keys`` (with ``dt`` among them); the newest ``version`` counts."""

    def __init__(self, path: str, keys: list[str], version: str = "dw_create_time"):
        self.path, self.keys, self.version = path.rstrip("/"), keys, version

    def replace_day(self, rows: DataFrame, dt: str) -> None:
        """The rows of ``dt`` as a night computed them; they stand for the whole day."""
        day, number = rows.where(F.col("dt") == dt), date.fromisoformat(dt).toordinal()
        write_batch(day, f"{self.path}/log", NIGHTLY, number)
        stored = day.sparkSession.read.parquet(f"{self.path}/log/source={NIGHTLY}/batch_id={number}")
        mark = stored.agg(F.lit(dt).alias("dt"), F.max(self.version).alias("loaded"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/loads/batch_id={number}")

    def upsert(self, source: str) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function for a stream's summary rows."""
        return upsert_versioned(f"{self.path}/log", source)

    def read(self, spark: SparkSession, dt: str | None = None) -> DataFrame:
        """What a reader sees, of one day or of all. At equal versions the nightly row counts."""
        rows = read_versions(spark, f"{self.path}/log")
        if dt is not None:
            rows = rows.where(F.col("dt") == dt)
        loads = spark.read.parquet(f"{self.path}/loads/batch_id=*").select(F.col("dt").alias("_day"), "loaded")
        nightly = F.col("source") == NIGHTLY
        joined = rows.join(loads, F.col("dt") == F.col("_day"), "left")
        valid = joined.where(nightly | F.col("loaded").isNull() | (F.col(self.version) > F.col("loaded")))
        newest = latest_version(valid.withColumn("_nightly", nightly), self.keys, self.version, ["_nightly", "batch_id"])
        return newest.drop("_day", "loaded", "_nightly", "source", "batch_id")

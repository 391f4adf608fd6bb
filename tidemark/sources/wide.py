"""Wide rows in key buckets: a folded base, the micro-batches since, and reads of the wanted buckets.

A table's folder holds ``log/source=/batch_id=`` (what streams and loads write, see
:mod:`tidemark.sources.changelog`), ``base/generation=/source=/bucket=`` (per source the newest row of every
key, as of a compaction) and ``generations/generation=`` (which batches a generation has folded). A reader
takes the newest generation that is committed and the batches after it, so it folds the tail, not the
history; with keys at hand it reads just their buckets of the base. Compaction writes a new generation
beside the old one and then commits it, so readers switch over in one step and a failure leaves nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.snapshots import latest_by_key
from tidemark.sources.changelog import column_changes, fold_columns, write_batch

BUCKETS = 256
GENERATIONS = "source string, folded bigint"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class WideTable:
    """Wide rows by ``key``. ``buckets`` is fixed for the life of the table."""

    def __init__(self, path: str, key: str = "rowkey", buckets: int = BUCKETS):
        self.path, self.key, self.buckets = path.rstrip("/"), key, buckets

    def upsert(self, source: str, version: str = "version", ties: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function that updates the family columns that its batches provide."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.load(batch, source, batch_id, version, ties)

        return write

    def load(
        self, rows: DataFrame, source: str, batch_id: int, version: str = "version", ties: tuple[str, ...] = ()
    ) -> None:
        """One batch of a source; the same batch id replaces itself. Rows are sorted by bucket, so that
        readers of some buckets skip row groups of the tail too."""
        newest = column_changes(rows, self.key, F.col(version), ties)
        placed = newest.withColumn("bucket", bucket_of(F.col(self.key), self.buckets))
        write_batch(placed.sortWithinPartitions("bucket", self.key), f"{self.path}/log", source, batch_id)

    def compact(self, spark: SparkSession, sources: list[str], open_batches: int = 1) -> int:
        """Fold the tail into a new generation of the base and return its number.

        Of every source the last ``open_batches`` batches stay in the tail, as they may still be being
        written. A source writes all its columns at once, so its newest row per key holds all that counts of
        it; the row keeps its version, and what other sources or later batches write between two versions is
        still compared column by column. Rows go to their bucket's task in one shuffle; a key has few.
        """
        number, folded = self.generation(spark)
        after = dict(folded)
        for source in sources:
            tail = self._tail(spark, source, folded.get(source))
            if tail is not None:
                batches = [row[0] for row in tail.select("batch_id").distinct().orderBy("batch_id").collect()]
                done = batches[: len(batches) - open_batches] if open_batches else batches
                after[source] = done[-1] if done else folded.get(source, -1)
            parts = self._parts(spark, source, number, folded.get(source), upto=after.get(source))
            if parts is not None:
                placed = parts.repartition(self.buckets, "bucket")
                newest = latest_by_key(placed, ["bucket", self.key], ["version", "batch_id"])
                target = f"{self.path}/base/generation={number + 1}/source={source}"
                newest.write.mode("overwrite").partitionBy("bucket").parquet(target)
        state = spark.createDataFrame(sorted(after.items()), GENERATIONS)
        state.write.mode("overwrite").parquet(f"{self.path}/generations/generation={number + 1}")
        return number + 1

    def generation(self, spark: SparkSession) -> tuple[int, dict[str, int]]:
        """The newest committed generation (0: none) and the last batch that it has folded of every source."""
        known = _parquet(spark, f"{self.path}/generations", f"{self.path}/generations")
        rows = known.collect() if known is not None else []
        number = max((row.generation for row in rows), default=0)
        return number, {row.source: row.folded for row in rows if row.generation == number}

    def _tail(self, spark: SparkSession, source: str, folded: int | None) -> DataFrame | None:
        tail = _parquet(spark, f"{self.path}/log/source={source}", f"{self.path}/log/source={source}")
        if tail is None:
            return None
        return tail if folded is None else tail.where(F.col("batch_id") > folded)

    def _parts(
        self, spark: SparkSession, source: str, number: int, folded: int | None, upto: int | None = None,
        buckets: list[int] | None = None,
    ) -> DataFrame | None:
        """The source's rows: its base and the batches after it."""
        tail = self._tail(spark, source, folded)
        if tail is not None and upto is not None:
            tail = tail.where(F.col("batch_id") <= upto)
        base = None
        if number:
            folder = f"{self.path}/base/generation={number}/source={source}"
            base = _parquet(spark, folder, folder)
        parts = [part for part in (base, tail) if part is not None]
        if buckets is not None:
            parts = [part.where(F.col("bucket").isin(buckets)) for part in parts]
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, spark: SparkSession, sources: list[str], buckets: list[int] | None = None) -> DataFrame:
        """The current wide rows: per column the newest value of the sources that provide it; of all keys, or
        of those in some buckets."""
        number, folded = self.generation(spark)
        logs = {}
        for source in sources:
            parts = self._parts(spark, source, number, folded.get(source), buckets=buckets)
            if parts is not None:
                logs[source] = parts.drop("bucket")
        if not logs:
            raise FileNotFoundError(f"none of {sources} has written to {self.path}")
        return fold_columns(logs, self.key)

    def read_for(self, keys: DataFrame, sources: list[str]) -> DataFrame:
        """The wide rows in the buckets of ``keys`` (a column named as the table's key). The numbers of
        the buckets, at most ``buckets``, are all that is collected."""
        wanted = keys.select(bucket_of(F.col(self.key), self.buckets).alias("bucket")).distinct()
        numbers = [row.bucket for row in wanted.collect() if row.bucket is not None]
        return self.read(keys.sparkSession, sources, numbers)

    def entity(self, spark: SparkSession, value: str, sources: list[str]) -> DataFrame:
        """The wide row of one key: one bucket of the base, whose file statistics skip other keys."""
        literal = F.lit(value)
        number = spark.range(1).select(bucket_of(literal, self.buckets)).first()[0]
        return self.read(spark, sources, [number]).where(F.col(self.key) == literal)


def _parquet(spark: SparkSession, path: str, base: str) -> DataFrame | None:
    """The table at ``path``; None if there is none, or nothing in it."""
    try:
        return spark.read.option("basePath", base).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise

"""Shared pieces of the operators: tables, written steps, word rules and Arrow slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_path

# Fixed value: what separates words, in Java, RE2 and Python patterns alike.
SPACE = "[\\x20\\x09-\\x0D]+"
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``df`` written once under the shared folder and read back, so that it is neither computed
    twice nor lost with an executor. From then on the session's queries give up their shuffle files as
    they end, instead of when the driver happens to collect its garbage."""
    spark = df.sparkSession
    spark.conf.set(SHUFFLE_CLEANUP_KEY, "true")
    path = path or work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written step that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_kept: dict[tuple, object] = {}


def keep(key: tuple, make: Callable[[], object]):
    """What a Python worker keeps for later tasks, made if it is not there. Only the newest is kept."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Let go what the worker keeps. Workers outlive a step, so tasks of steps that keep nothing begin with
    this; else an earlier step's memory would count on top of theirs."""
    _kept.clear()
    pa.default_memory_pool().release_unused()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def in_fold(id_column: str, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; null ids count as the text "null"."""
    name = F.coalesce(F.col(id_column).cast("string"), F.lit("null"))
    return F.crc32(name.cast("binary")) % modulus == rest


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in pieces whose texts hold about ``limit`` bytes, at least a row each, so that the
    working memory of a task does not follow the length of its texts."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)

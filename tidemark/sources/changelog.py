"""Keyed tables fed by micro-batches: an append-only change log plus a folded read.

Each micro-batch writes only its own rows, into a folder named by source and batch id. A batch
that is replayed after a failure replaces its own folder, so the effect is exactly once. Readers
fold the log by key; :func:`compact` folds it into a new base so that reads stay short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.serving import latest_version
from tidemark.operators.snapshots import latest_by_key


def write_batch(df: DataFrame, path: str, source: str, batch_id: int) -> None:
    """Write one micro-batch of one source; the same batch id replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/source={source}/batch_id={batch_id}")


def upsert_versioned(
    path: str, source: str, change: Callable[[DataFrame], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends rows as new versions of their keys."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = change(batch) if change else batch
        write_batch(rows, path, source, batch_id)

    return write


def read_versions(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All versions, with ``source`` and ``batch_id``."""
    reader = spark.read
    if schema is not None:
        full = T.StructType(
            [*schema.fields, T.StructField("source", T.StringType()), T.StructField("batch_id", T.LongType())]
        )
        reader = reader.schema(full)
    return reader.option("basePath", path).parquet(f"{path}/source=*/batch_id=*")


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest version per key; batch ids order the versions of one stream."""
    rows = latest_version(read_versions(spark, path), keys, "batch_id")
    return rows.drop("source", "batch_id")


def compact_latest(spark: SparkSession, path: str, target: str, keys: list[str]) -> None:
    """Start a new log at ``target`` with just the newest rows; the stream goes on writing there
    with its next batch ids, which all rank after the base."""
    newest = read_latest(spark, path, keys).hint("rebalance")
    newest.write.mode("overwrite").parquet(f"{target}/source=base/batch_id=-1")


def column_changes(
    df: DataFrame, key: str, version: Column, ties: tuple[str, ...] = ()
) -> DataFrame:
    """A batch's rows reduced to the newest per key, stamped with their ``version``."""
    return latest_by_key(df.withColumn("version", version), [key], ["version", *ties])


def upsert_columns(
    path: str, source: str, key: str = "rowkey", version: str = "version", ties: tuple[str, ...] = ()
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that updates just the family columns the batch provides."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(column_changes(batch, key, F.col(version), ties), path, source, batch_id)

    return write


def _leaves(schema: T.StructType, skip: set[str]) -> dict[str, list[str]]:
    return {
        field.name: [leaf.name for leaf in field.dataType.fields]
        for field in schema.fields
        if field.name not in skip and isinstance(field.dataType, T.StructType)
    }


def fold_columns(changes: dict[str, DataFrame], key: str = "rowkey") -> DataFrame:
    """The current wide rows out of several sources that each write some family columns.

    ``changes`` maps a source to its rows: key, ``version`` and family structs. Every column
    takes its value from the newest row among the sources that provide that column; a null
    written by such a row is a value. Of one source's rows with equal versions the later batch
    counts. One shuffle by key, reduced map-side, with a row per source and key and not a value per column.
    """
    skip = {key, "version", "source", "batch_id"}
    layout: dict[str, dict[str, None]] = {}
    provided: dict[str, set[tuple[str, str]]] = {}
    for source, df in changes.items():
        provided[source] = set()
        for family, leaves in _leaves(df.schema, skip).items():
            for leaf in leaves:
                layout.setdefault(family, {})[leaf] = None
                provided[source].add((family, leaf))
    flat = None
    for source, df in changes.items():
        batch = F.col("batch_id").cast("long") if "batch_id" in df.columns else F.lit(0).cast("long")
        row = F.struct(
            F.col("version").alias("version"),
            batch.alias("batch"),
            *(F.col(f"{family}.{leaf}").alias(f"{family}__{leaf}") for family, leaf in sorted(provided[source])),
        )
        part = df.select(key, row.alias(f"of_{source}"))
        flat = part if flat is None else flat.unionByName(part, allowMissingColumns=True)

    def stamp(source: str) -> Column:
        row = F.col(f"of_{source}")
        return F.when(row.isNotNull(), F.struct(row["version"], row["batch"]))

    # A source writes all its columns at once: its newest row holds all that counts of it.
    folded = flat.groupBy(key).agg(
        *(F.max_by(f"of_{source}", stamp(source)).alias(f"of_{source}") for source in changes)
    )

    def newest(family: str, leaf: str) -> Column:
        rows = {source: F.col(f"of_{source}") for source in changes if (family, leaf) in provided[source]}
        if len(rows) == 1:
            return [*rows.values()][0][f"{family}__{leaf}"]
        stamped = (
            F.when(row.isNotNull(), F.struct(row["version"].alias("version"), F.lit(source).alias("source"), row[f"{family}__{leaf}"].alias("value")))
            for source, row in rows.items()
        )
        return F.greatest(*stamped)["value"]

    versions = [F.col(f"of_{source}")["version"] for source in changes]
    folded = folded.select(
        key,
        (F.greatest(*versions) if len(versions) > 1 else versions[0]).alias("version"),
        *(newest(family, leaf).alias(f"{family}__{leaf}") for family, leaves in layout.items() for leaf in leaves),
    )
    return folded.select(
        key,
        "version",
        *(
            F.struct(*(F.col(f"{family}__{leaf}").alias(leaf) for leaf in leaves)).alias(family)
            for family, leaves in layout.items()
        ),
    )


def read_columns(spark: SparkSession, path: str, sources: list[str], key: str = "rowkey") -> DataFrame:
    """The current wide rows from the change log of the named sources; those that have not written
    yet provide nothing."""
    logs = {source: log for source in sources if (log := _log(spark, path, source)) is not None}
    if not logs:
        raise FileNotFoundError(f"none of {sources} has written to {path}")
    return fold_columns(logs, key)


def _log(spark: SparkSession, path: str, source: str) -> DataFrame | None:
    try:
        return spark.read.option("basePath", path).parquet(f"{path}/source={source}/batch_id=*")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def compact(spark: SparkSession, path: str, target: str, sources: list[str], key: str = "rowkey") -> None:
    """Start a new log at ``target`` with the newest row per key of every source.

    A source writes all its columns at once, so its newest row holds all that counts of it, and the
    row keeps its version: what another source, or a later batch, writes between two versions is
    still compared column by column. Streams go on writing there with their next batch ids.
    """
    for source in sources:
        if (log := _log(spark, path, source)) is not None:
            newest = latest_by_key(log, [key], ["version", "batch_id"]).drop("source", "batch_id")
            newest.hint("rebalance").write.mode("overwrite").parquet(f"{target}/source={source}/batch_id=-1")

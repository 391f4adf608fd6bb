"""Serving-side operators: newest version, batch over speed, key protection, family rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.derive import reverse_key
from tidemark.operators.rows import fill_defaults
from tidemark.operators.snapshots import latest_by_key


def latest_version(
    df: DataFrame, keys: list[str], version: str = "dw_create_time", ties: Iterable[str] = ()
) -> DataFrame:
    """What a reader of a replace-by-version table sees: the newest row per key."""
    return latest_by_key(df, keys, [version, *ties])


def unify_batch_speed(
    batch: DataFrame, speed: DataFrame, keys: list[str], version: str = "dw_create_time"
) -> DataFrame:
    """The nightly rows and the intraday rows as one table; per key the newest version is kept.

    At equal version the nightly row wins, being the complete one.
    """
    both = batch.withColumn("_nightly", F.lit(1)).unionByName(
        speed.withColumn("_nightly", F.lit(0)), allowMissingColumns=True
    )
    return latest_version(both, keys, version, ["_nightly"]).drop("_nightly")


def protect_keys(df: DataFrame, sentinels: dict[str, object]) -> DataFrame:
    """Replace null key columns by their sentinels."""
    return fill_defaults(df, sentinels)


def pack_families(df: DataFrame, key: Column, families: dict[str, dict[str, Column]]) -> DataFrame:
    """A row key and one struct of text columns per family."""
    return df.select(
        key.alias("rowkey"),
        *(
            F.struct(*(column.cast("string").alias(name) for name, column in columns.items())).alias(family)
            for family, columns in families.items()
        ),
    )


def unpack_families(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Flat typed columns out of family structs: ``{name: ("family.column", type)}``."""
    return df.select(
        "rowkey",
        *(F.col(path).try_cast(kind).alias(name) for name, (path, kind) in columns.items()),
    )


def fresh_rows(df: DataFrame, updated_on: Column, through: str) -> DataFrame:
    """Rows last updated on or before ``through``; a null update day is dropped."""
    return df.where(updated_on <= F.lit(through))


def lookup_entity(df: DataFrame, key: object, key_column: str = "rowkey", reverse: bool = True) -> DataFrame:
    """The row of one entity; the predicate reaches the scan, so Parquet skips row groups."""
    value = reverse_key(F.lit(key)) if reverse else F.lit(key)
    return df.where(F.col(key_column) == value)

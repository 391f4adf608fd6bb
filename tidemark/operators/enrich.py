"""Joins of facts to dimensions. All are equi joins; their physical form is left to AQE.

No broadcast hint is given: dimensions here grow with the data. AQE broadcasts a side once its
shuffled size is known to be under the session's threshold, and otherwise sorts and merges,
splitting the partitions of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _join_keys(fact: DataFrame, dim: DataFrame, keys: list[str]) -> list[str]:
    """The keys, plus the day when both sides carry one."""
    day = ["dt"] if "dt" in fact.columns and "dt" in dim.columns and "dt" not in keys else []
    return [*day, *keys]


def left_enrich(fact: DataFrame, dim: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Add dimension columns; facts without a dimension row keep nulls."""
    on = _join_keys(fact, dim, keys)
    return fact.join(dim.select(*on, *columns), on, "left")


def inner_enrich(fact: DataFrame, dim: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Add dimension columns; facts without a dimension row are dropped."""
    on = _join_keys(fact, dim, keys)
    return fact.join(dim.select(*on, *columns), on, "inner")

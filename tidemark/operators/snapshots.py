"""Daily snapshots: newest row per key, roll-forward of totals, key sets."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame, keys: Iterable[str], order: Iterable[str | Column]
) -> DataFrame:
    """The newest row of each key by descending ``order`` (nulls last), ties cut by later entries.

    Spark turns ``row_number() = 1`` into a per-task group limit before the shuffle, so each map
    task sends one row per key at most and a key holding a third of the rows stays cheap.
    """
    descending = [
        F.col(name).desc_nulls_last() if isinstance(name, str) else name for name in order
    ]
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*descending))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def newer_wins(old: str, new: str, order: str) -> Column:
    """Whether the row in struct ``new`` replaces the one in ``old``; at equal ``order`` it does."""
    old_at, new_at = F.col(f"{old}.{order}"), F.col(f"{new}.{order}")
    newer = old_at.isNull() | F.coalesce(new_at >= old_at, F.lit(False))
    return F.col(old).isNull() | (F.col(new).isNotNull() & newer)


def merge_latest(
    previous: DataFrame, changes: DataFrame, keys: list[str], order: str, ties: Iterable[str] = ()
) -> DataFrame:
    """The previous rows with the changes applied: per key the row with the newer ``order`` wins.

    ``previous`` holds one row per key; ``changes`` may hold several. At equal ``order`` the
    change wins. One full outer join on the key: the snapshot is shuffled once (not at all when
    it is stored bucketed by the key) and never sorted by anything but the key.
    """
    newest = latest_by_key(changes, keys, [order, *ties])
    columns = [c for c in previous.columns if c not in keys]
    old = previous.select(*keys, F.struct(*columns).alias("_old"))
    new = newest.select(*keys, F.struct(*columns).alias("_new"))
    row = F.when(newer_wins("_old", "_new", order), F.col("_new")).otherwise(F.col("_old"))
    merged = old.join(new, keys, "full").withColumn("_row", row)
    return merged.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in columns)).select(*previous.columns)


def fold_by_key(parts: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Put parts (one row per key each) side by side: the keys and one struct column per part.

    The result is that of a chain of full outer joins, but each part moves once: a full outer join
    loses its partitioning, so a chain would move all columns again at every link. A key has at
    most one row per part here, so no key can be hot.
    """
    # Each part is dealt by key on its own, which costs nothing for parts that come out of an
    # aggregation by the key; a union of parts dealt alike needs no shuffle of its own.
    rows = [
        df.select(*keys, F.struct(*(c for c in df.columns if c not in keys)).alias(name)).repartition(*keys)
        for name, df in parts.items()
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return union.groupBy(*keys).agg(*(F.first(name, ignorenulls=True).alias(name) for name in parts))


def key_spine(keys: list[str], *frames: DataFrame) -> DataFrame:
    """Every key found in any of the frames, once."""
    return reduce(DataFrame.unionByName, (frame.select(*keys) for frame in frames)).distinct()


def assemble(spine: DataFrame, parts: Iterable[DataFrame], keys: list[str]) -> DataFrame:
    """Left-join parts (one row per key each) to the spine; all joins share the key's partitioning."""
    return reduce(lambda left, part: left.join(part, keys, "left"), parts, spine)


def new_keys(today: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``today`` whose key did not exist before."""
    return today.join(before.select(*keys), keys, "left_anti")


def carried_total(before: str, delta: str) -> Column:
    """Yesterday's total plus today's delta, a missing side counting 0."""
    zero = F.lit(0)
    return F.coalesce(F.col(before), zero) + F.coalesce(F.col(delta), zero)


def accumulate_snapshot(
    previous: DataFrame, deltas: DataFrame, keys: list[str], totals: dict[str, str]
) -> DataFrame:
    """Roll totals forward: ``{total column: delta column}`` over the union of both key sets.

    ``deltas`` may hold several rows per key (several days); they are summed first, map-side.
    """
    summed = deltas.groupBy(*keys).agg(
        *(F.sum(delta).alias(f"_delta_{total}") for total, delta in totals.items())
    )
    return previous.join(summed, keys, "full").select(
        *keys, *(carried_total(total, f"_delta_{total}").alias(total) for total in totals)
    )


def stamp(touched: Column, now: Column, before: Column) -> Column:
    """``now`` for rows that changed today, otherwise what they had."""
    return F.when(touched, now).otherwise(before)

"""Cumulative windows over stored events: running totals per step inside a larger window."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def utc_offset_start(hours_east: int) -> str:
    """The ``startTime`` that aligns day windows to local midnight of a fixed-offset zone."""
    return f"{(24 - hours_east) % 24} hours"


def window_day(bound: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(bound, pattern)


def cumulate(
    df: DataFrame,
    at: str,
    step: str,
    size: str,
    keys: Iterable[str] = (),
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
    firsts: dict[str, str] | None = None,
    distincts: dict[str, str] | None = None,
    dense: bool = False,
    start: str = "0 seconds",
) -> DataFrame:
    """Totals from each window's start up to every step: keys, window_start, window_end, metrics.

    ``sums`` and ``maxima`` map output names to row-level columns, ``firsts`` to the column whose
    first value by time is wanted, ``distincts`` to the column whose values are counted once per window.

    Rows are first reduced to one per key and step (map-side), so the running window sees at most
    size/step rows per key and window, whatever the number of events. Distinct counts go by first
    appearance: a value counts in the step it is first seen in, which needs no per-key set.
    By default a key has a row for the steps in which it changed; ``dense`` repeats the
    totals for every later step up to the end of the window.
    """
    keys, sums, maxima = list(keys), sums or {}, maxima or {}
    firsts, distincts = firsts or {}, distincts or {}
    by = [*keys, "window_start", "step_end"]
    stepped = df.withColumns(
        {
            **{f"_sum_{name}": column for name, column in sums.items()},
            **{f"_max_{name}": column for name, column in maxima.items()},
            "window_start": F.window(at, size, startTime=start)["start"],
        }
    ).withColumn("step_end", F.window(at, step, startTime=start)["end"])

    # One reduction for all metrics: a row stands once for its step and once for each value to be counted. The
    # former are grouped by step, the latter by value, whose smallest step is that of its first appearance.
    named = list(distincts)
    types = dict(stepped.dtypes)
    sides = [F.struct(F.lit(0).alias("side"), F.col("step_end").alias("step"), *(
        F.lit(None).cast(types[distincts[n]]).alias(f"value{k}") for k, n in enumerate(named)
    ))]
    for at_side, name in enumerate(named):
        values = (
            (F.col(distincts[name]) if k == at_side else F.lit(None).cast(types[distincts[other]])).alias(f"value{k}")
            for k, other in enumerate(named)
        )
        side = F.struct(F.lit(at_side + 1).alias("side"), F.lit(None).cast("timestamp").alias("step"), *values)
        sides.append(F.when(F.col(distincts[name]).isNotNull(), side))
    group = ["side", "step", *(f"value{k}" for k in range(len(named)))]
    rows = stepped
    if named:
        rows = stepped.withColumn("_once", F.explode(F.array_compact(F.array(*sides))))
        rows = rows.select("*", *(F.col(f"_once.{c}").alias(f"_{c}") for c in group)).drop("_once")
    own = F.col("_side") == 0 if named else F.lit(True)
    by_value = [*keys, "window_start", *(f"_{c}" for c in group)] if named else by

    def counted(column: Column) -> Column:
        return F.when(own, column) if named else column

    parts = rows.groupBy(*by_value).agg(
        *([F.min("step_end").alias("_step_end")] if named else []),
        *(F.sum(counted(F.col(f"_sum_{name}"))).alias(name) for name in sums),
        *(F.max(counted(F.col(f"_max_{name}"))).alias(name) for name in maxima),
        # Of rows at the same time the smallest value is the first.
        *(F.min_by(column, counted(F.struct(F.col(at), F.col(column)))).alias(name) for name, column in firsts.items()),
    )
    if named:
        parts = parts.groupBy(*keys, "window_start", F.col("_step_end").alias("step_end")).agg(
            *(F.sum(name).alias(name) for name in sums),
            *(F.max(name).alias(name) for name in maxima),
            *(F.max(F.when(own, F.col(name))).alias(name) for name in firsts),
            *(F.count_if(F.col("_side") == k + 1).alias(name) for k, name in enumerate(named)),
        )

    inside = Window.partitionBy(*keys, "window_start").orderBy("step_end")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = parts.select(
        *keys,
        "window_start",
        F.col("step_end").alias("window_end"),
        *(F.sum(name).over(running).alias(name) for name in (*sums, *distincts)),
        *(F.max(name).over(running).alias(name) for name in maxima),
        *(F.first(name).over(running).alias(name) for name in firsts),
        *([F.lead("step_end").over(inside).alias("_next_end")] if dense else []),
    )
    if not dense:
        return totals
    one_step, whole = F.expr(f"INTERVAL {step}"), F.expr(f"INTERVAL {size}")
    last = F.coalesce(F.col("_next_end") - one_step, F.col("window_start") + whole)
    return totals.withColumn(
        "window_end", F.explode(F.sequence(F.col("window_end"), last, one_step))
    ).drop("_next_end")


def cumulate_final(
    df: DataFrame, at: str, size: str, keys: Iterable[str], metrics: list[Column], start: str = "0 seconds"
) -> DataFrame:
    """Only the last cumulative row of each window: what an upserted table holds in the end."""
    return (
        df.withColumn("_window", F.window(at, size, startTime=start))
        .groupBy("_window", *keys)
        .agg(*metrics)
        .withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")})
        .drop("_window")
    )

"""Row-level operators: quality flags, required ids, defaults, placeholders, key protection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality_flags(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Add ``is_valid`` and ``invalid_reason`` (the first required column that is null)."""
    reason = F.coalesce(
        *(F.when(F.col(name).isNull(), F.lit(f"missing_{name}")) for name in required)
    )
    flagged = df.withColumn("invalid_reason", reason)
    return flagged.withColumn("is_valid", F.col("invalid_reason").isNull())


def require(df: DataFrame, not_null: Iterable[str] = (), not_blank: Iterable[str] = ()) -> DataFrame:
    """Keep rows whose ids are present; blank text counts as missing for ``not_blank``."""
    for name in not_null:
        df = df.where(F.col(name).isNotNull())
    for name in not_blank:
        df = df.where(F.col(name).isNotNull() & (F.col(name) != ""))
    return df


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace nulls by per-column defaults, keeping each column's type."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value).cast(types[name]))
            for name, value in defaults.items()
            if name in types
        }
    )


def placeholders(columns: dict[str, tuple[str, object]]) -> list[Column]:
    """Constant columns, ``{name: (type, value)}``, for what only the nightly job can fill."""
    return [F.lit(value).cast(kind).alias(name) for name, (kind, value) in columns.items()]


def normalize_reply_key(event: str = "event_id", own: str = "rpid", parent: str = "parent_rpid") -> Column:
    """The comment an event is credited to: a reply counts for its parent."""
    return F.when(F.col(event) == "comment_reply", F.col(parent)).otherwise(F.col(own))

"""String-to-value casts that give null on bad input (ANSI casts would fail the job)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_whole(value: Column | str, type_name: str = "bigint") -> Column:
    """Integer from text; a decimal text is cut at the point, anything else unparsable is null."""
    text = _column(value)
    return F.coalesce(text.try_cast(type_name), text.try_cast("decimal(38,6)").try_cast(type_name))


def typed_sql(text: str, type_name: str) -> str:
    """SQL that turns a text expression into a column type, null where the text does not fit.

    ``flag`` is a boolean of the words true and false only, in any case.
    """
    if type_name == "string":
        return text
    if type_name in ("bigint", "int"):
        return f"coalesce(try_cast({text} AS {type_name}), try_cast(try_cast({text} AS decimal(38,6)) AS {type_name}))"
    if type_name == "flag":
        return f"CASE lower({text}) WHEN 'true' THEN true WHEN 'false' THEN false END"
    return f"try_cast({text} AS {type_name})"


def parse_bool_ci(value: Column | str) -> Column:
    """Only the words true and false, in any case; everything else is null."""
    word = F.lower(_column(value))
    return F.when(word == "true", True).when(word == "false", False)


def ms_to_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp of whole seconds."""
    return F.timestamp_seconds(F.call_function("div", _column(ms), F.lit(1000)))


def digits_ms_to_timestamp(text: Column | str) -> Column:
    """Like :func:`ms_to_timestamp` for text; null unless the text is digits only."""
    raw = _column(text)
    return F.when(raw.rlike("^[0-9]+$"), ms_to_timestamp(as_whole(raw)))


def ms_to_text(ms: Column | str, pattern: str) -> Column:
    """Epoch milliseconds formatted in the session time zone."""
    return F.date_format(ms_to_timestamp(ms), pattern)

"""Derived account columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.casts import ms_to_timestamp
from tidemark.functions.labels import MONTHLY_PLAN_MAX_DAYS

DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def _day_text(birthday: Column) -> Column:
    return F.when(birthday.rlike(DAY_PATTERN), birthday)


def age_by_days(birthday: Column, as_of: Column) -> Column:
    """Whole years of 365.25 days up to ``as_of``; null for text that is not a calendar date."""
    days = F.date_diff(F.to_date(as_of), F.try_to_date(_day_text(birthday), "yyyy-MM-dd"))
    return F.floor(days / F.lit(365.25)).cast("int")


def age_by_calendar(birthday: Column, as_of: Column) -> Column:
    """Completed calendar years up to ``as_of``."""
    born = F.try_to_date(_day_text(birthday), "yyyy-MM-dd")
    return F.floor(F.months_between(F.to_date(as_of), born) / 12).cast("int")


def birth_year(birthday: Column) -> Column:
    return F.substring(_day_text(birthday), 1, 4).cast("int")


def account_age_days(created_ms: Column, as_of: Column) -> Column:
    return F.date_diff(F.to_date(as_of), F.to_date(ms_to_timestamp(created_ms))).cast("int")


def is_official(official_type: Column) -> Column:
    return F.coalesce(official_type >= 0, F.lit(False))


def tag_array(tags_json: Column) -> Column:
    """A JSON list of tags as an array; null, blank or broken text gives the empty array."""
    return F.coalesce(F.from_json(tags_json, "array<string>"), F.array().cast("array<string>"))


def array_text(values: Column) -> Column:
    """An array as text, ``[]`` when it is null or empty."""
    return F.coalesce(values.cast("string"), F.lit("[]"))


def reverse_key(value: Column) -> Column:
    """The row key: the id's text reversed."""
    return F.reverse(value.cast("string"))


def json_text(**columns: Column) -> Column:
    """One-line JSON text of the given columns, null numbers as 0 and null text as ''."""
    return F.to_json(F.struct(*(value.alias(name) for name, value in columns.items())))


def end_of_day(dt: str | Column) -> Column:
    day = F.lit(dt) if isinstance(dt, str) else dt
    return F.to_timestamp(F.concat(day, F.lit(" 23:59:59")))


def _expiry_seconds(value: Column, unit: str) -> Column:
    if unit not in ("ms", "s"):
        raise ValueError("expire_unit must be 'ms' or 's'")
    return F.call_function("div", value, F.lit(1000)) if unit == "ms" else value


def vip_state(
    dt: str | Column,
    new_expire: Column,
    plan_days: Column,
    old_expire: Column,
    old_type: Column,
    expire_unit: str = "ms",
) -> tuple[Column, Column]:
    """(vip_expire, vip_type) after a day's newest paid order, if there is one.

    A paid order sets the expiry; a running expiry is carried over; one that does not reach
    past the end of the day gives type 0. Plans of up to 31 days are monthly, others yearly.
    The numbers keep the unit the source sends; the comparison uses the undivided value.
    """
    closing = end_of_day(dt)
    scale = 1000 if expire_unit == "ms" else 1
    expire = F.when(
        new_expire.isNotNull(), F.timestamp_seconds(_expiry_seconds(new_expire, expire_unit))
    ).otherwise(old_expire)
    bought = F.when(
        new_expire > F.unix_timestamp(closing) * scale,
        F.when(plan_days <= MONTHLY_PLAN_MAX_DAYS, 1).otherwise(2),
    ).otherwise(0)
    vip_type = (
        F.when(new_expire.isNotNull(), bought).when(old_expire > closing, old_type).otherwise(0)
    )
    return expire, vip_type

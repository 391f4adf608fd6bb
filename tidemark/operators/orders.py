"""Accumulating order rows from order events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.labels import ORDER_STATUS_BY_EVENT

# Event columns folded by maximum and by minimum, and the closing events.
KEEP_MAX = (
    "mid current_vip_type current_vip_expire_ts plan_id plan_name plan_duration_days original_price "
    "final_price discount_amount coupon_id pay_method pay_duration_sec new_vip_expire_ts error_code "
    "error_msg retry_count cancel_stage"
).split()
KEEP_MIN = "device_id platform app_version channel ip from_page trace_id session_id".split()
CLOSING_EVENTS = ("vip_pay_success", "vip_pay_fail", "vip_pay_cancel")
STATUS_PRIORITY = (*CLOSING_EVENTS, "vip_pay_start")


def status_by_priority(event: str = "event_id") -> Column:
    """success, else fail, else cancel, else paying, else created."""
    status: Column = F.lit("created")
    for name in reversed(STATUS_PRIORITY):
        reached = F.coalesce(F.bool_or(F.col(event) == name), F.lit(False))
        status = F.when(reached, ORDER_STATUS_BY_EVENT[name]).otherwise(status)
    return status


def milestones(event: str = "event_id", at: str = "server_ts") -> list[Column]:
    name, when = F.col(event), F.col(at)
    return [
        F.min(F.when(name == "vip_create_order", when)).alias("create_ts"),
        F.min(F.when(name == "vip_pay_start", when)).alias("pay_start_ts"),
        F.max(F.when(name.isin(*CLOSING_EVENTS), when)).alias("pay_end_ts"),
    ]


def accumulate_order(
    events: DataFrame, keys: list[str], newest: bool = False, extra: tuple[Column, ...] = ()
) -> DataFrame:
    """One row per order: folded fields, status by priority, milestone times.

    ``extra`` aggregates are added as they are. "Any value" fields keep the largest one; with ``newest`` the last non-null one by
    ``server_ts``. All folds combine map-side, so an order key with many events is no hot spot.
    """

    def fold(name: str) -> Column:
        if newest:
            seen_at = F.when(F.col(name).isNotNull(), F.col("server_ts"))
            return F.max_by(name, seen_at).alias(name)
        return F.max(name).alias(name)

    present = events.columns
    return events.groupBy(*keys).agg(
        *(fold(name) for name in KEEP_MAX if name in present),
        status_by_priority().alias("order_status"),
        *milestones(),
        *(F.min(name).alias(name) for name in KEEP_MIN if name in present),
        *extra,
    )

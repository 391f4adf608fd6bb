"""Code-to-label mappings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and event names as the source system defines them.
VIP_TYPE_LABELS = {0: "普通用户", 1: "月度大会员", 2: "年度大会员"}
ACCOUNT_STATUS_LABELS = {0: "正常", 1: "封禁", 2: "注销"}
UNKNOWN_LABEL = "未知"
ORDER_STATUS_BY_EVENT = {
    "vip_create_order": "created",
    "vip_pay_start": "paying",
    "vip_pay_success": "success",
    "vip_pay_fail": "fail",
    "vip_pay_cancel": "cancel",
}
MONTHLY_PLANS = ("monthly", "auto_monthly")
MONTHLY_PLAN_MAX_DAYS = 31


def code_label(code: Column, labels: dict, default: str | None = UNKNOWN_LABEL) -> Column:
    """The label of ``code``; null and unlisted codes give ``default``."""
    chain = None
    for key, label in labels.items():
        condition, value = code == F.lit(key), F.lit(label)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain.otherwise(F.lit(default))


def vip_type_name(code: Column) -> Column:
    return code_label(code, VIP_TYPE_LABELS)


def account_status_name(code: Column) -> Column:
    return code_label(code, ACCOUNT_STATUS_LABELS)


def event_to_status(event: Column) -> Column:
    """Order status reached by an order event; ``unknown`` for any other event."""
    return code_label(event, ORDER_STATUS_BY_EVENT, "unknown")


def vip_type_from_plan(plan_id: Column) -> Column:
    """1 for the monthly plans, 2 for every other or missing plan."""
    return F.when(plan_id.isin(*MONTHLY_PLANS), 1).otherwise(2)

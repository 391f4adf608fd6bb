"""Conditional aggregate expressions over event rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

HEARTBEAT_SECONDS = 15
TRIPLE_COINS = 2


def event_is(events: str | Iterable[str], event: str = "event_id") -> Column:
    names = [events] if isinstance(events, str) else list(events)
    return F.col(event).isin(*names) if len(names) > 1 else F.col(event) == names[0]


def count_event(*events: str) -> Column:
    return F.count_if(event_is(events))


def net_delta(plus: Iterable[str], minus: Iterable[str]) -> Column:
    return F.sum(F.when(event_is(plus), 1).when(event_is(minus), -1).otherwise(0))


def credit(amounts: dict[str, Column | int]) -> Column:
    """Sum of a per-event amount; other events add 0."""
    chain = None
    for event, amount in amounts.items():
        value = amount if isinstance(amount, Column) else F.lit(amount)
        condition = event_is(event)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return F.sum(chain.otherwise(0))


def distinct_for(event: str, value: str) -> Column:
    return F.count_distinct(F.when(event_is(event), F.col(value)))


def whole_ratio(amount: Column, base: Column) -> Column:
    """``amount / base`` cut to an integer; null when the base is 0."""
    return (amount / F.nullif(base, F.lit(0))).cast("int")


def interaction_metrics(triple_counts: bool, names: dict[str, str] | None = None) -> list[Column]:
    """The view, like, coin, favorite, share and danmaku metrics of video events.

    With ``triple_counts`` one "triple" also counts as a like, two coins and a favorite.
    ``names`` renames output columns.
    """
    triple = ("video_triple",) if triple_counts else ()
    coins: dict[str, Column | int] = {"video_coin": F.coalesce(F.col("coin_count"), F.lit(1))}
    if triple_counts:
        coins["video_triple"] = TRIPLE_COINS
    metrics = {
        "view_count": count_event("video_view"),
        "total_play_duration_sec": count_event("video_play_heartbeat") * HEARTBEAT_SECONDS,
        "like_count_delta": count_event("video_like", *triple),
        "unlike_count_delta": count_event("video_unlike"),
        "net_like_delta": net_delta(("video_like", *triple), ("video_unlike",)),
        "coin_count_delta": count_event("video_coin", *triple),
        "coin_total_delta": credit(coins),
        "favorite_count_delta": count_event("video_favorite", *triple),
        "unfavorite_count_delta": count_event("video_unfavorite"),
        "net_favorite_delta": net_delta(("video_favorite", *triple), ("video_unfavorite",)),
        "share_count": count_event("video_share"),
        "danmaku_count": count_event("video_danmaku"),
        "triple_count": count_event("video_triple"),
    }
    names = names or {}
    return [column.alias(names.get(name, name)) for name, column in metrics.items()]

"""Pending orders: a state per order with a time limit, and membership updates on payment."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from tidemark.functions.derive import reverse_key
from tidemark.functions.labels import vip_type_from_plan, vip_type_name
from tidemark.operators.rows import require
from tidemark.operators.snapshots import latest_by_key
from tidemark.plans.serving import SECONDS
from tidemark.sources.streams import parse_messages, with_event_time
from tidemark.streaming import schemas
from tidemark.streaming.dims import start_upsert

DEFAULT_TTL_SECONDS = 3600
# Shards of the state of pending orders.
SHARDS = 1 << 12
CHANGE_SCHEMA = (
    "order_no string, change string, mid bigint, plan_id string, new_vip_expire bigint, server_ts bigint, "
    "was_pending boolean"
)
# What goes through the tracker: ids that may be null as text, as pandas holds whole numbers beside nulls as doubles.
GIVEN = ["order_no", "server_ts", "event_id", "mid", "plan_id", "new_vip_expire"]
TRACKED = "order_no string, change string, mid string, plan_id string, new_vip_expire string, server_ts bigint, was_pending boolean"
CREATED = "vip_create_order"
# What an event does to its order.
CHANGES = {
    "vip_create_order": "created",
    "vip_pay_success": "paid",
    "vip_pay_fail": "ended",
    "vip_pay_cancel": "ended",
}


def order_events(raw: DataFrame, delay: str = "5 seconds") -> DataFrame:
    """Order events that change an order's state, with event time; unreadable messages are dropped."""
    messages = parse_messages(raw.where(F.col("topic") == "app_event_vip"), schemas.VIP_EVENT)
    known = require(messages, not_null=("server_ts",), not_blank=("order_no",))
    changing = known.where(F.col("event_id").isin(*CHANGES))
    return with_event_time(changing, delay=delay).select(
        "order_no",
        "event_id",
        "mid",
        "server_ts",
        "event_time",
        F.col("properties.plan_id").alias("plan_id"),
        F.col("properties.new_vip_expire").alias("new_vip_expire"),
    )


class OrderTracker(StatefulProcessor):
    """The orders of one shard: the last event in time order of each, and a timer for the first time limit to end."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState(
            "held", "order_no array<string>, server_ts array<bigint>, event_id array<string>"
        )

    def _read(self) -> dict[str, tuple[int, str]]:
        held = self.held.get()
        return {} if held is None else {order_no: (at, event) for order_no, at, event in zip(*held)}

    def _write(self, held: dict[str, tuple[int, str]]) -> None:
        if held:
            self.held.update(([*held], [at for at, _ in held.values()], [event for _, event in held.values()]))
        else:
            self.held.clear()

    def _timer(self, held: dict[str, tuple[int, str]]) -> int | None:
        return min(at for at, _ in held.values()) + self.ttl_ms if held else None

    def _over(self, last: tuple | None, watermark: int) -> bool:
        return last is not None and last[0] + self.ttl_ms < watermark

    def _expired(self, order_no: str, last: tuple) -> list[tuple]:
        """The row of an order that was still pending; one that had ended is forgotten in silence."""
        return [(order_no, "expired", None, None, None, last[0] + self.ttl_ms, True)] if last[1] == CREATED else []

    def _follow(self, order_no: str, last: tuple | None, events: list[tuple]) -> tuple[tuple, list[tuple]]:
        """The last of all of the order's events, and the rows of the new ones."""
        # All rows of the micro-batch at once: their order must not depend on how they were brought.
        steps = [(at, event, True, row) for _, at, event, *row in events]
        steps += [(*last, False, None)] if last else []
        steps.sort(key=lambda step: step[:3])
        rows, prior = [], None
        for at, event, new, row in steps:
            if new:
                pending = prior is not None and prior[1] == CREATED and at - prior[0] <= self.ttl_ms
                rows.append((order_no, CHANGES[event], *row, at, pending))
            prior = at, event
        return prior, rows

    def _frames(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame(rows, columns=["order_no", "change", "mid", "plan_id", "new_vip_expire", "server_ts", "was_pending"])

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held = self._read()
        timer = self._timer(held)
        arrived: dict[str, list[tuple]] = {}
        for frame in rows:
            for event in zip(*(frame[name].tolist() for name in GIVEN)):
                arrived.setdefault(event[0], []).append(event)
        out = []
        for order_no, events in arrived.items():
            last = held.pop(order_no, None)
            if self._over(last, watermark):
                out += self._expired(order_no, last)
                last = None
            last, changed = self._follow(order_no, last, events)
            out += changed
            if self._over(last, watermark):
                out += self._expired(order_no, last)
            else:
                held[order_no] = last
        self._write(held)
        if (first := self._timer(held)) != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        yield from self._frames(out)

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        watermark, held = timerValues.getCurrentWatermarkInMs(), self._read()
        over = {order_no: last for order_no, last in held.items() if self._over(last, watermark)}
        left = {order_no: last for order_no, last in held.items() if order_no not in over}
        self._write(left)
        if left:
            self.handle.registerTimer(self._timer(left))
        yield from self._frames([row for order_no, last in over.items() for row in self._expired(order_no, last)])

    def close(self) -> None:
        pass


def order_changes(
    events: DataFrame, ttl_seconds: int = DEFAULT_TTL_SECONDS, shards: int = SHARDS
) -> DataFrame:
    """The state changes of orders: created, paid, ended, expired, and whether the order was pending.

    Creating an order makes it pending; paying, failing or cancelling ends that; a pending order is
    forgotten ``ttl_seconds`` after its creation. A payment is passed on in any case. The limit is
    measured in event time, so a replay of the same micro-batches gives the same rows.

    Orders are dealt by hash over ``shards``, whose number is fixed for the life of the checkpoint. A shard's
    state holds the last event of each of its orders and is read and written once per micro-batch, with one
    timer: calls between Spark and Python go by shard, not by order. A micro-batch touches the shards of the
    orders that it has events of and those whose timer is over, whatever the number of the others; choose as
    many shards as leave each some hundred pending orders. States lie in RocksDB, outside the memory of the
    tasks. A task holds the orders of one shard and its events in a micro-batch. The session must be one of
    ``stream_session(..., keyed=True)``.

    Rows behind the watermark are taken like others; the watermark only tells when time limits are over.
    Rows are worked off in time order, within a micro-batch and against what is held. An order that has
    ended is held for ``ttl_seconds`` too, so that its creation, should it come later, leaves it ended.
    What was passed on before a late row came is not taken back.
    """
    # Spark drops rows whose column with the watermark's mark is behind the watermark. That column is given as
    # null, which is behind nothing; the watermark itself is taken from the times below it.
    mark = events.schema["event_time"].metadata
    timeless = F.lit(None).cast("timestamp").alias("event_time", metadata=mark)
    numbers = ("mid", "new_vip_expire")
    given = [F.col(c).cast("string").alias(c) if c in numbers else F.col(c) for c in GIVEN]
    shard = F.pmod(F.xxhash64("order_no"), F.lit(shards)).cast("int").alias("shard")
    tracked = events.select(shard, *given, timeless).groupBy("shard").transformWithStateInPandas(
        OrderTracker(ttl_seconds * 1000), TRACKED, "append", "EventTime"
    )
    return tracked.withColumns({c: F.col(c).cast("bigint") for c in numbers})


def pending_orders(changes: DataFrame) -> DataFrame:
    """Orders that are pending after the given changes: those whose last change created them."""
    return latest_by_key(changes, ["order_no"], ["server_ts", "change"]).where(F.col("change") == "created")


def paid_orders(events: DataFrame) -> DataFrame:
    """The payments among order events. A payment counts whether or not its order was pending, so
    membership updates need no state at all."""
    paid = events.where(F.col("event_id") == "vip_pay_success")
    return paid.select("order_no", "mid", "plan_id", "new_vip_expire", "server_ts")


def vip_updates(paid: DataFrame, run_ts: Column, expire_unit: str = "s") -> DataFrame:
    """Membership columns of the accounts that paid; rows without account or expiry are skipped."""
    kept = require(paid, not_null=("mid", "new_vip_expire"))
    seconds = F.col("new_vip_expire")
    if expire_unit == "ms":
        seconds = F.call_function("div", seconds, F.lit(1000))
    kind = vip_type_from_plan(F.col("plan_id"))
    now = F.date_format(run_ts, SECONDS)
    return kept.select(
        reverse_key(F.col("mid")).alias("rowkey"),
        F.col("server_ts").alias("version"),
        F.struct(
            kind.cast("string").alias("vip_type"),
            vip_type_name(kind).alias("vip_type_name"),
            F.date_format(F.timestamp_seconds(seconds), SECONDS).alias("vip_expire"),
        ).alias("status"),
        F.struct(now.alias("updated_at"), now.alias("dw_update_time")).alias("etl"),
    )


def start_vip_updates(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    run_ts: Column,
    trigger: str | None = None,
    expire_unit: str = "s",
) -> StreamingQuery:
    """Order messages to membership columns in the account table at ``path``."""
    paid = paid_orders(order_events(raw))
    return start_upsert(vip_updates(paid, run_ts, expire_unit), path, "vip_orders", checkpoint, trigger)

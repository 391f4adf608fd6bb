from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.session import stream_session, work_path
from tidemark.sources import changelog
from tidemark.sources.jdbc import jdbc_options, jdbc_sink
from tidemark.sources.raw import read_raw
from tidemark.sources.streams import kafka_options, parse_messages
from tidemark.streaming import dims, lookups, orders, summaries
from tidemark.streaming.landing import land_raw_events
from tidemark.streaming.runs import fan_out, run_to_end, start

BASE = 1709251200000  # 2024-03-01 00:00:00 UTC
STREAM_PARTITIONS = 4
RAW = "json_str string, topic string, arrival timestamp"


class Feed:
    """A folder of message files and the stream that reads it, one file per micro-batch."""

    def __init__(self, spark):
        self.spark, self.path, self.count = spark, work_path(spark, "feed"), 0
        spark.createDataFrame([], RAW).write.parquet(f"{self.path}/empty")

    def add(self, topic, *bodies, arrival=0):
        rows = [(b if isinstance(b, str) else json.dumps(b), topic, arrival) for b in bodies]
        df = self.spark.createDataFrame(rows, "json_str string, topic string, s bigint")
        df = df.select("json_str", "topic", F.timestamp_seconds(F.col("s") + BASE // 1000).alias("arrival"))
        df.coalesce(1).write.parquet(f"{self.path}/{self.count:04d}")
        self.count += 1

    def stream(self, keyed=False):
        reader = stream_session(self.spark, STREAM_PARTITIONS, keyed).readStream.schema(RAW).option("maxFilesPerTrigger", 1)
        return reader.option("recursiveFileLookup", "true").parquet(self.path)

    def batch(self):
        return self.spark.read.schema(RAW).option("recursiveFileLookup", "true").parquet(self.path)


@pytest.fixture
def feed(spark):
    return Feed(spark)


def video(name, mid, bvid, second, **properties):
    return {"event_id": name, "mid": mid, "bvid": bvid, "server_ts": BASE + second * 1000, "properties": properties}


def now():
    return F.lit("2024-03-01 12:00:00").cast("timestamp")


def test_stream_and_batch_reach_the_same_totals(spark, feed, rows):
    feed.add("app_event_video", video("video_view", 1, "BV1", 1), video("video_triple", 1, "BV2", 2), "{broken")
    feed.add("app_event_video", video("video_view", 1, "BV1", 3), video("video_coin", 2, "BV1", 3, coin_count=2))
    feed.add("app_event_video", video("video_like", 1, "BV1", 4), video("video_publish", 1, "BV7", 4))
    path = work_path(spark, "live")
    run_to_end(summaries.UPLOADER.start(feed.stream(), f"{path}/rows", f"{path}/c"))
    streamed = summaries.UPLOADER.read(spark, f"{path}/rows", now())
    batch = summaries.UPLOADER.view(summaries.UPLOADER.totals(summaries.UPLOADER.parse(feed.batch())), now())
    assert rows(streamed) == rows(batch)
    got = rows(streamed, "mid", "video_cnt", "total_view_count", "total_like_delta", "total_coin_total_delta", "dt")
    assert got == [(1, 2, 2, 2, 2, "2024-03-01"), (2, 1, 0, 0, 2, "2024-03-01")]


def test_restart_goes_on_from_the_checkpoint(spark, feed, rows):
    path = work_path(spark, "live")
    feed.add("app_event_account", {"event_id": "account_register", "mid": 1, "server_ts": BASE})
    run_to_end(summaries.REGISTRATION.start(feed.stream(), f"{path}/rows", f"{path}/c"))
    feed.add("app_event_account", {"event_id": "account_register", "mid": 2, "server_ts": BASE + 1000})
    run_to_end(summaries.REGISTRATION.start(feed.stream(), f"{path}/rows", f"{path}/c"))
    assert rows(summaries.REGISTRATION.read(spark, f"{path}/rows", now()), "new_account_cnt", "sex") == [(2, "unknown")]


def test_events_later_than_the_watermark_are_dropped(spark, feed, rows):
    feed.add("app_event_account", {"event_id": "account_register", "mid": 1, "server_ts": BASE + 1000})
    feed.add("app_event_account", {"event_id": "account_register", "mid": 2, "server_ts": BASE + 86_400_000 + 60_000})
    # A batch is judged by the watermark of the batch before the last one.
    feed.add("app_event_account", {"event_id": "account_register", "mid": 4, "server_ts": BASE + 86_400_000 + 61_000})
    feed.add("app_event_account", {"event_id": "account_register", "mid": 3, "server_ts": BASE + 2000})
    path = work_path(spark, "live")
    run_to_end(summaries.REGISTRATION.start(feed.stream(), f"{path}/rows", f"{path}/c"))
    got = rows(summaries.REGISTRATION.read(spark, f"{path}/rows", now()), "dt", "new_account_cnt")
    assert got == [("2024-03-01", 1), ("2024-03-02", 2)]


def test_day_stamp_by_window_end_falls_on_the_next_day(spark, feed, rows):
    feed.add("app_event_account", {"event_id": "account_register", "mid": 1, "server_ts": BASE + 1000})
    totals = summaries.REGISTRATION.totals(summaries.REGISTRATION.parse(feed.batch()))
    assert rows(summaries.REGISTRATION.view(totals, now()), "dt") == [("2024-03-01",)]
    assert rows(summaries.REGISTRATION.view(totals, now(), stamp_end=True), "dt") == [("2024-03-02",)]


def test_a_replayed_batch_replaces_itself(spark, rows):
    path = work_path(spark, "versions")
    sink = changelog.upsert_versioned(path, "s")
    df = spark.createDataFrame([(1, 5)], "k int, n int")
    sink(df, 0)
    sink(spark.createDataFrame([(1, 7), (2, 1)], "k int, n int"), 1)
    sink(spark.createDataFrame([(1, 7), (2, 1)], "k int, n int"), 1)
    assert rows(changelog.read_latest(spark, path, ["k"])) == [(1, 7), (2, 1)]
    assert changelog.read_versions(spark, path).count() == 3
    target = work_path(spark, "versions-compacted")
    changelog.compact_latest(spark, path, target, ["k"])
    changelog.upsert_versioned(target, "s")(spark.createDataFrame([(2, 9)], "k int, n int"), 2)
    assert rows(changelog.read_latest(spark, target, ["k"])) == [(1, 7), (2, 9)]


def wide(spark, rowkey, version, **families):
    fields = ", ".join(f"'{name}', named_struct({', '.join(f'{c!r}, {v}' for c, v in columns.items())})" for name, columns in families.items())
    return spark.sql(f"SELECT '{rowkey}' AS rowkey, CAST({version} AS BIGINT) AS version, inline(array(named_struct({fields})))")


def test_column_upserts_touch_only_their_columns(spark, rows):
    path = work_path(spark, "wide")
    attributes, counters = changelog.upsert_columns(path, "attributes"), changelog.upsert_columns(path, "counters")
    attributes(wide(spark, "k", 1, basic={"title": "'a'", "mid": "'1'"}, status={"vip": "'0'"}), 0)
    counters(wide(spark, "k", 2, stats={"views": "'5'"}), 0)
    counters(wide(spark, "k", 3, stats={"views": "'6'"}), 1)
    attributes(wide(spark, "k", 4, basic={"title": "'b'", "mid": "CAST(NULL AS STRING)"}, status={"vip": "'1'"}), 1)
    vip = changelog.upsert_columns(path, "vip")
    vip(wide(spark, "k", 3, status={"vip": "'9'"}), 0)
    vip(wide(spark, "j", 3, status={"vip": "'2'"}), 1)
    got = changelog.read_columns(spark, path, ["attributes", "counters", "vip"]).orderBy("rowkey").collect()
    assert [r["rowkey"] for r in got] == ["j", "k"]
    assert got[0]["status"]["vip"] == "2" and got[0]["basic"]["title"] is None
    assert (got[1]["basic"]["title"], got[1]["basic"]["mid"]) == ("b", None)
    assert (got[1]["stats"]["views"], got[1]["status"]["vip"]) == ("6", "1")
    target = work_path(spark, "compacted")
    changelog.compact(spark, path, target, ["attributes", "counters", "vip"])
    changelog.upsert_columns(target, "counters")(wide(spark, "k", 9, stats={"views": "'7'"}), 0)
    sources = ["attributes", "counters", "vip", "never_written"]
    after = {r["rowkey"]: r for r in changelog.read_columns(spark, target, sources).collect()}
    assert (after["k"]["stats"]["views"], after["k"]["basic"]["title"], after["j"]["status"]["vip"]) == ("7", "b", "2")


def test_compaction_keeps_a_version_per_source(spark):
    path, target = work_path(spark, "between"), work_path(spark, "between-compacted")
    changelog.upsert_columns(path, "attributes")(wide(spark, "k", 100, basic={"title": "'old'"}), 0)
    changelog.upsert_columns(path, "counters")(wide(spark, "k", 200, stats={"views": "'5'"}), 0)
    changelog.compact(spark, path, target, ["attributes", "counters"])
    changelog.upsert_columns(target, "attributes")(wide(spark, "k", 150, basic={"title": "'new'"}), 1)
    got = changelog.read_columns(spark, target, ["attributes", "counters"]).first()
    assert (got["basic"]["title"], got["stats"]["views"], got["version"]) == ("new", "5", 200)


def test_a_later_batch_wins_at_an_equal_version(spark):
    path = work_path(spark, "ties")
    counters = changelog.upsert_columns(path, "counters")
    counters(wide(spark, "k", 5, stats={"views": "'2'"}), 0)
    counters(wide(spark, "k", 5, stats={"views": "'1'"}), 1)
    assert changelog.read_columns(spark, path, ["counters"]).first()["stats"]["views"] == "1"


def test_counters_on_top_of_the_snapshot(spark, feed, rows):
    feed.add("app_event_video", video("video_view", 1, "BV1", 1), video("video_like", 1, "BV1", 1))
    base = spark.createDataFrame([("BV1", 100, 0, 0, 0, 0, -1)], "bvid string, view_count int, danmaku_count int, favorite_count int, coin_count int, share_count int, like_count int")
    path = work_path(spark, "counters")
    run_to_end(
        dims.start_counters(
            dims.video_counters(feed.stream()), dims.video_key(), path, "counters", f"{path}-c", trigger=None,
            base=base, keys=("bvid",),
        )
    )
    got = changelog.read_columns(spark, path, ["counters"]).first()
    assert (got["rowkey"], got["stats"]["view_count"], got["stats"]["like_count"]) == ("1VB", "101", "0")


def vip(name, order, second, mid=1, **properties):
    return {"event_id": name, "mid": mid, "order_no": order, "server_ts": BASE + second * 1000, "properties": properties}


def test_pending_order_state(spark, feed, rows):
    feed.add("app_event_vip", vip("vip_create_order", "a", 0), vip("vip_create_order", "b", 0), vip("vip_create_order", "c", 0))
    feed.add("app_event_vip", vip("vip_pay_success", "a", 60, plan_id="monthly", new_vip_expire=BASE // 1000))
    feed.add("app_event_vip", vip("vip_pay_cancel", "b", 90), vip("vip_pay_success", "x", 95), vip("vip_pay_success", "", 95))
    feed.add("app_event_vip", vip("vip_pay_success", "b", 99), vip("vip_pay_start", "b", 99))
    feed.add("app_event_vip", vip("vip_pay_success", "c", 200), vip("vip_create_order", "d", 9000), vip("vip_create_order", "e", 12000))
    path = work_path(spark, "orders")
    changes = orders.order_changes(orders.order_events(feed.stream(keyed=True)), ttl_seconds=100)
    run_to_end(start(changes, lambda df, n: df.write.mode("overwrite").parquet(f"{path}/rows/batch_id={n}"), f"{path}/c", mode="append"))
    stored = spark.read.schema(orders.CHANGE_SCHEMA).parquet(f"{path}/rows/batch_id=*")
    paid = rows(stored.where("change = 'paid'"), "order_no", "was_pending")
    assert paid == [("a", True), ("b", False), ("c", False), ("x", False)]
    assert rows(stored.where("change = 'expired'"), "order_no") == [("d",)], "orders that were not paid in time"
    assert rows(orders.pending_orders(stored), "order_no") == [("e",)]


def test_order_changes_do_not_depend_on_the_size_of_arrow_batches(spark, feed, rows):
    feed.add("app_event_vip", vip("vip_pay_success", "a", 200), vip("vip_create_order", "a", 100))
    path, stream = work_path(spark, "orders"), feed.stream(keyed=True)
    stream.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        changes = orders.order_changes(orders.order_events(stream), ttl_seconds=100)
        run_to_end(start(changes, lambda df, n: df.write.mode("overwrite").parquet(f"{path}/rows/batch_id={n}"), f"{path}/c", mode="append"))
    finally:
        stream.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    stored = spark.read.schema(orders.CHANGE_SCHEMA).parquet(f"{path}/rows/batch_id=*")
    assert rows(stored.where("change = 'paid'"), "order_no", "was_pending") == [("a", True)]


def test_late_rows_change_orders(spark, feed, rows):
    create, pay = "vip_create_order", "vip_pay_success"
    feed.add("app_event_vip", vip(create, "a", 0), vip(create, "b", 0), vip(create, "c", 10))
    feed.add("app_event_vip", vip(create, "d", 80), vip(pay, "f", 75))
    feed.add("app_event_vip", vip(pay, "a", 10), vip(create, "f", 60), vip("vip_pay_cancel", "c", 20))
    feed.add("app_event_vip", vip(create, "e", 1000))
    feed.add("app_event_vip", vip(create, "i", 1050))
    feed.add("app_event_vip", vip(pay, "b", 20), vip(create, "g", 5), vip(pay, "y", 1))
    feed.add("app_event_vip", vip(create, "h", 1100))
    path = work_path(spark, "orders")
    changes = orders.order_changes(orders.order_events(feed.stream(keyed=True)), ttl_seconds=100)
    run_to_end(start(changes, lambda df, n: df.write.mode("overwrite").parquet(f"{path}/rows/batch_id={n}"), f"{path}/c", mode="append"))
    stored = spark.read.schema(orders.CHANGE_SCHEMA).parquet(f"{path}/rows/batch_id=*")
    seen = stored.withColumn("second", F.expr(f"(server_ts - {BASE}) div 1000"))
    # "b" was paid in time, but its payment came after its limit had been over; "f" was paid before its creation came.
    assert rows(seen.where("change in ('paid', 'ended')"), "order_no", "second", "was_pending") == [
        ("a", 10, True), ("b", 20, False), ("c", 20, True), ("f", 75, False), ("y", 1, False)
    ]
    assert rows(seen.where("change = 'created'"), "order_no", "second") == [
        ("a", 0), ("b", 0), ("c", 10), ("d", 80), ("e", 1000), ("f", 60), ("g", 5), ("h", 1100), ("i", 1050)
    ]
    assert rows(seen.where("change = 'expired'"), "order_no", "second") == [("b", 100), ("d", 180), ("g", 105)]
    assert rows(orders.pending_orders(stored), "order_no") == [("e",), ("h",), ("i",)]


class CountedState:
    """A shard's state and timers, as the tracker's handle gives them, with the number of calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def _call(self):
        self.calls += 1

    def get(self):
        self._call()
        return self.value

    def update(self, value):
        self._call()
        self.value = value

    def clear(self):
        self._call()
        self.value = None

    def registerTimer(self, at):
        self._call()
        self.timers.append(at)

    def deleteTimer(self, at):
        self._call()
        self.timers.remove(at)


def test_the_calls_of_order_states_do_not_grow_with_the_orders(spark):
    class Now:
        def __init__(self, watermark):
            self.getCurrentWatermarkInMs = lambda: watermark

    state, tracker = CountedState(), orders.OrderTracker(100)
    tracker.init(state)
    events = [(f"o{n}", n, "vip_create_order", "1", None, None) for n in range(1000)]
    frames = [pd.DataFrame(events[:400], columns=orders.GIVEN), pd.DataFrame(events[400:], columns=orders.GIVEN)]
    made = list(tracker.handleInputRows((0,), iter(frames), Now(0)))
    assert sum(map(len, made)) == 1000 and state.timers == [100] and state.calls <= 3
    state.timers.clear()
    over = list(tracker.handleExpiredTimer((0,), Now(600), None))
    assert sum(map(len, over)) == 500 and state.timers == [600] and state.calls <= 6


def test_large_ids_of_orders_are_whole_beside_nulls(spark, feed, rows):
    """A whole number beside a null must not pass through a double."""
    large = 9007199254740993
    feed.add("app_event_vip", vip("vip_create_order", "a", 0, mid=large), vip("vip_pay_success", "b", 1, mid=None, new_vip_expire=large))
    path = work_path(spark, "orders")
    # One shard, so that all rows are in one frame.
    changes = orders.order_changes(orders.order_events(feed.stream(keyed=True)), ttl_seconds=100, shards=1)
    run_to_end(start(changes, lambda df, n: df.write.parquet(f"{path}/rows/batch_id={n}"), f"{path}/c", mode="append"))
    stored = spark.read.schema(orders.CHANGE_SCHEMA).parquet(f"{path}/rows/batch_id=*")
    assert rows(stored, "order_no", "mid", "new_vip_expire") == [("a", large, None), ("b", None, large)]


def test_an_order_expires_just_after_its_limit(spark, feed, rows):
    """The watermark is 5 seconds behind the newest event; a limit that it just reaches is not over."""
    create = "vip_create_order"
    feed.add("app_event_vip", vip(create, "a", 0), vip(create, "b", 1), vip(create, "late", 106))
    feed.add("app_event_vip", vip(create, "c", 3), vip(create, "very late", -200))
    path = work_path(spark, "orders")
    changes = orders.order_changes(orders.order_events(feed.stream(keyed=True)), ttl_seconds=100)
    run_to_end(start(changes, lambda df, n: df.write.mode("overwrite").parquet(f"{path}/rows/batch_id={n}"), f"{path}/c", mode="append"))
    stored = spark.read.schema(orders.CHANGE_SCHEMA).parquet(f"{path}/rows/batch_id=*")
    assert rows(stored.where("change = 'expired'"), "order_no") == [("a",), ("very late",)]
    assert rows(orders.pending_orders(stored), "order_no") == [("b",), ("c",), ("late",)]


def test_vip_updates_skip_incomplete_payments(spark, feed, rows):
    feed.add(
        "app_event_vip", vip("vip_pay_success", "a", 1, plan_id="monthly", new_vip_expire=BASE // 1000),
        vip("vip_pay_success", "b", 2, mid=None, new_vip_expire=1), vip("vip_pay_success", "c", 3, mid=2), "nonsense",
    )
    updates = orders.vip_updates(orders.paid_orders(orders.order_events(feed.batch())), now())
    row = updates.collect()
    assert [(r["rowkey"], r["status"]["vip_type"], r["status"]["vip_expire"]) for r in row] == [("1", "1", "2024-03-01 00:00:00")]
    assert row[0]["status"]["vip_type_name"] == "月度大会员" and row[0]["etl"]["updated_at"] == "2024-03-01 12:00:00"


def test_landing_by_record_day_and_topic(spark, feed, rows):
    feed.add("app_event_video", '{"a":1}', "not json", arrival=10)
    feed.add("app_comment", '{"b":1}', arrival=90_000)
    path = work_path(spark, "landing")
    run_to_end(land_raw_events(feed.stream(), f"{path}/raw", f"{path}/c"))
    assert rows(read_raw(spark, f"{path}/raw")) == [
        ("not json", "2024-03-01", "app_event_video"), ('{"a":1}', "2024-03-01", "app_event_video"),
        ('{"b":1}', "2024-03-02", "app_comment"),
    ]


def test_lookups_and_fan_out(spark, feed, rows):
    feed.add("app_event_video", video("video_view", 12, "BV1", 1), video("video_view", 7, "BV2", 1))
    videos = wide(spark, "1VB", 1, basic={"pubdate": "'5'"}, content={"title": "'t'", "duration": "'9'", "category_id": "'3'", "category_name": "'c'"}, meta={"pub_date": "'d'"})
    accounts = wide(
        spark, "21", 1, basic={"nick_name": "'n'", "sex": "'s'", "level": "'6'"}, status={"vip_type": "'1'", "vip_type_name": "'v'"},
        official={"official_type": "'-1'", "official_desc": "'o'", "is_official": "'false'"}, relation={"follower_cnt": "'8'", "following_cnt": "'2'"},
    )
    path = work_path(spark, "lookup")
    sink = fan_out(changelog.upsert_versioned(f"{path}/one", "s"), changelog.upsert_versioned(f"{path}/two", "s"))
    totals = summaries.VIDEO.totals(summaries.VIDEO.parse(feed.stream()))
    run_to_end(lookups.start_enriched(totals, lambda keys: videos, lambda keys: accounts, sink, f"{path}/c"))
    for name in ("one", "two"):
        got = rows(changelog.read_latest(spark, f"{path}/{name}", ["bvid", "mid"]), "bvid", "title", "duration", "mid", "level", "is_official")
        assert got == [("BV1", "t", 9, 12, 6, False), ("BV2", None, None, 7, None, None)]


def test_missing_fields_are_null_and_unreadable_messages_are_dropped(spark, rows):
    df = spark.createDataFrame([('{"a":1}',), ("{broken",), ('{"a":"x","b":"y"}',), (None,), ("[1]",)], "json_str string")
    assert rows(parse_messages(df, "a bigint, b string")) == [(1, None), (None, "y")]


def test_kafka_and_jdbc_options():
    options = kafka_options("h:1", pattern="app_.*")
    assert options["subscribePattern"] == "app_.*" and options["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka_options("h:1")
    written = jdbc_options("jdbc:x", "t", driver="d")
    assert (written["batchsize"], written["dbtable"], written["driver"]) == ("5000", "t", "d")
    assert callable(jdbc_sink(url="jdbc:x", table="t"))

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.relations import relation_counts, relation_rollforward
from tidemark.plans import detail, dims, stats
from tidemark.plans.nightly import run_day
from tidemark.plans.serving import SENTINELS, Serving, load_summary, night_version
from tidemark.sources.daily import DailyTable
from tidemark.sources.raw import RAW_SCHEMA, scan_raw
from tidemark.sources.tables import ROLLED_KEYS, MissingSnapshot, Tables, days_back

DAYS = ["2024-03-01", "2024-03-02", "2024-03-03"]
DAY_MS = 86_400_000
START_MS = 1709251200000  # 2024-03-01 00:00:00 UTC


def ms(day: int, hour: float = 12) -> int:
    return int(START_MS + day * DAY_MS + hour * 3_600_000)


def messages():
    """Three days of messages with the awkward cases: an order paid after midnight, an un-like without
    a like, a re-sent video, one comment id under two videos, a broken message."""
    out = []

    def add(topic, day, body):
        out.append((body if isinstance(body, str) else json.dumps(body), DAYS[day], topic))

    def event(topic, day, name, mid, hour=12, properties=None, **more):
        add(topic, day, {"event_id": name, "mid": mid, "server_ts": ms(day, hour), "properties": properties or {}, **more})

    for day in range(3):
        event("app_event_video", day, "video_view", 10 + day, bvid="BV1")
        event("app_event_video", day, "video_unlike", 10, bvid="BV2")
        event("app_event_video", day, "video_coin", 10, bvid="BV1", properties={"coin_count": day} if day else {})
        event("app_event_social", day, "social_follow", 10, target_mid=20 + day)
        event("app_event_comment", day, "comment_create", 10, oid="BV1", rpid=1, properties={"otype": 1})
        event("app_event_comment", day, "comment_like", 10, oid="BV1", rpid=1)
    add("app_event_video", 1, "{broken")
    event("app_event_social", 1, "social_follow", 20, target_mid=10)
    event("app_event_social", 2, "social_unfollow", 10, target_mid=20)
    event("app_event_comment", 1, "comment_like", 10, oid="BV2", rpid=1)
    event("app_event_comment", 2, "comment_create", 10, oid="BV9", rpid=9)
    add("app_video_content", 0, {"bvid": "BV1", "title": "one", "mid": 20, "updated_at": ms(0, 1)})
    add("app_video_content", 2, {"bvid": "BV1", "title": "two", "mid": 20, "updated_at": ms(2, 20)})
    add("app_comment", 0, {"rpid": 1, "oid": "BV1", "root": 0, "content": "hi", "updated_at": ms(0, 1)})
    add("app_user_profile", 0, {"mid": 10, "nick_name": "ten", "tags": ["a, b"], "updated_at": ms(0, 1)})
    add("app_user_profile", 2, {"mid": 20, "nick_name": "twenty", "updated_at": ms(2, 1)})
    event("app_event_vip", 0, "vip_create_order", 10, hour=23.9, order_no="V1", properties={"plan_duration_days": 31})
    event("app_event_vip", 1, "vip_pay_success", 10, hour=0.1, order_no="V1", properties={"new_vip_expire": ms(40)})
    event("app_event_vip", 1, "vip_page_view", 10, order_no="")
    return out


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    spark.createDataFrame(messages(), RAW_SCHEMA).write.mode("overwrite").partitionBy("dt", "topic").parquet(path)
    return spark.read.schema(RAW_SCHEMA).parquet(path)


@pytest.fixture(scope="module")
def tables(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    for n, day in enumerate(DAYS):
        done = run_day(spark, raw, root, day, f"{day} 23:59:00", bootstrap=n == 0, serving=Serving(f"{root}/serving", 4))
    return done


@pytest.fixture(scope="module")
def serving(tables):
    return Serving(f"{tables.root}/serving", 4)


def test_nights_load_the_summaries_by_day(spark, tables, serving, rows):
    for table in SENTINELS:
        days = serving.summary(table).read(spark)
        want = load_summary(table, tables.read(table))
        assert days.count() == want.count() > 0
        assert rows(days.select(*sorted(set(days.columns) - {"dw_create_time"}))) == rows(want.select(*sorted(set(days.columns) - {"dw_create_time"})))
        assert rows(serving.summary(table).read(spark, DAYS[1]).select("dt").distinct()) in ([], [(DAYS[1],)])


def test_a_day_loaded_again_loses_the_keys_it_no_longer_has(spark, tmp_path, rows):
    schema = "mid long, dt string, n long, dw_create_time timestamp"
    day = DailyTable(str(tmp_path), ["mid", "dt"])
    at = lambda *r: spark.createDataFrame([(m, d, n, dt.datetime(2024, 3, 2, h)) for m, d, n, h in r], schema)
    day.upsert("live")(at((1, "2024-03-01", 5, 0), (2, "2024-03-01", 6, 1), (3, "2024-03-01", 7, 9), (1, "2024-03-02", 8, 1)), 0)
    day.replace_day(at((1, "2024-03-01", 50, 2), (4, "2024-03-01", 60, 2), (9, "2024-03-02", 1, 2)), "2024-03-01")
    assert rows(day.read(spark), "mid", "dt", "n") == [(1, "2024-03-01", 50), (1, "2024-03-02", 8), (3, "2024-03-01", 7), (4, "2024-03-01", 60)]
    day.replace_day(at((1, "2024-03-01", 51, 3)), "2024-03-01")
    assert rows(day.read(spark, "2024-03-01"), "mid", "n") == [(1, 51), (3, 7)]


def test_nights_load_wide_rows_over_live_ones(spark, tables, serving, rows):
    sources = ["live", "nightly"]
    wide = serving.wide("video")
    before = {r.rowkey: r for r in wide.read(spark, sources).collect()}
    key = "BV1"[::-1]
    assert before[key].content.title == "two" and before[key].version == night_version(DAYS[2])
    live = lambda version, title: spark.createDataFrame([(key, version, title)], "rowkey string, version long, t string").selectExpr(
        "rowkey", "version", "named_struct('title', t) AS content")
    wide.upsert("live")(live(night_version(DAYS[2]) - 5, "older"), 0)
    assert wide.entity(spark, key, sources).first().content.title == "two"
    wide.upsert("live")(live(night_version(DAYS[2]) + 5, "newer"), 1)
    row = wide.entity(spark, key, sources).first()
    assert row.content.title == "newer" and row.stats.view_count == before[key].stats.view_count
    assert serving.compact(spark, "video", ["live"]) == 1
    assert rows(wide.read(spark, sources).select("rowkey")) == sorted((k,) for k in before)
    serving.load_wide("video", tables.scan_snapshot("dim_video_df", DAYS[2]), DAYS[2])
    assert wide.entity(spark, key, sources).first().content.title == "newer"


def test_raw_scan_lists_one_folder(raw):
    plan = scan_raw(raw, "app_event_video", DAYS[0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "PushedFilters: []" in plan


def test_totals_after_three_days_equal_one_pass(tables, raw, rows):
    chained = rows(tables.scan_snapshot("dim_video_df", DAYS[2]).where("bvid <> 'BV9'"), "bvid", "view_count", "coin_count", "like_count")
    whole = stats.video_stats(detail.video_actions(raw, columns=stats.VIDEO_STATS_INPUT))
    once = whole.groupBy("bvid").agg(F.sum("view_count"), F.sum("coin_total_delta"), F.sum("net_like_delta"))
    assert chained == rows(once) == [("BV1", 3, 4, 0), ("BV2", 0, 0, -3)]


def test_relations_after_three_days(tables, raw, rows):
    got = {r["mid"]: r for r in tables.scan_snapshot("dim_account_df", DAYS[2]).collect()}
    assert got[10]["following_list"] == [21, 22] and got[10]["follower_list"] == [20]
    assert got[20]["following_list"] == [10] and got[20]["mutual_follow_list"] == []
    assert (got[10]["following_chg"], got[20]["follower_chg"]) == (0, -1)
    for row in got.values():
        assert row["mutual_follow_cnt"] <= min(row["following_cnt"], row["follower_cnt"])
    chained = rows(relation_counts(tables.scan_snapshot("dim_account_relation_df", DAYS[2])).select("mid", "following_cnt").where("following_cnt > 0"))
    assert chained == [(10, 2), (20, 1)]


def test_profile_columns_come_from_todays_messages_only(tables):
    day1 = {r["mid"]: r for r in tables.scan_snapshot("dim_account_df", DAYS[0]).collect()}
    day3 = {r["mid"]: r for r in tables.scan_snapshot("dim_account_df", DAYS[2]).collect()}
    assert (day1[10]["nick_name"], day1[10]["tags"], day1[10]["tag_cnt"]) == ("ten", ["a, b"], 1)
    assert (day3[10]["nick_name"], day3[20]["nick_name"]) == (None, "twenty")


def test_carried_forward_profile(spark, raw, tmp_path):
    for n, day in enumerate(DAYS[:2]):
        done = run_day(spark, raw, str(tmp_path), day, f"{day} 23:59:00", bootstrap=n == 0, carry_forward=True)
    kept = done.scan_snapshot("dim_account_df", DAYS[1]).where("mid = 10").first()
    assert (kept["nick_name"], kept["tags"]) == ("ten", ["a, b"])


def test_attributes_and_stamps(tables):
    day2 = {r["bvid"]: r for r in tables.scan_snapshot("dim_video_df", DAYS[1]).collect()}
    day3 = {r["bvid"]: r for r in tables.scan_snapshot("dim_video_df", DAYS[2]).collect()}
    assert (day2["BV1"]["title"], day3["BV1"]["title"]) == ("one", "two")
    assert day3["BV1"]["updated_date"] == DAYS[2] and day2["BV2"]["title"] is None
    assert "BV9" not in day3, "a video that only got a comment is not added"
    assert day3["BV1"]["reply_count"] == 3


def test_comments_are_kept_apart_by_video(tables, rows):
    got = rows(tables.scan_snapshot("dim_comment_df", DAYS[2]).where("rpid = 1"), "oid", "like_count", "content", "is_root")
    assert got == [("BV1", 3, "hi", True), ("BV2", 1, None, None)]


def test_order_paid_after_midnight(tables, raw, rows):
    assert rows(tables.scan_snapshot("dwd_order_vip_di", DAYS[0]), "order_no", "order_status") == [("V1", "created")]
    paid = tables.scan_snapshot("dwd_order_vip_di", DAYS[1]).first()
    assert (paid["order_status"], paid["create_ts"], paid["plan_duration_days"]) == ("success", None, None)
    whole = detail.vip_orders(raw, DAYS[1], lookback_days=1).collect()
    assert [(r["order_no"], r["create_ts"], r["plan_duration_days"], r["dt"]) for r in whole] == [("V1", ms(0, 23.9), 31, DAYS[1])]
    account = tables.scan_snapshot("dim_account_df", DAYS[2]).where("mid = 10").first()
    assert account["vip_type"] == 2, "the plan length is unknown on the day of payment"


def test_summaries(tables, rows):
    got = rows(tables.scan_snapshot("dws_video_stats_account_di", DAYS[2]), "mid", "nick_name", "video_cnt", "total_view_count")
    assert got == [(20, "twenty", 1, 1), (None, None, 1, 0)]
    new = tables.scan_snapshot("dws_account_registry_source_di", DAYS[1]).agg(F.sum("new_account_cnt")).first()[0]
    assert new == 1, "account 21 is new on the second day"
    orders = tables.scan_snapshot("dws_vip_order_source_di", DAYS[1]).first()
    assert (orders["order_cnt"], orders["order_user_cnt"], orders["order_status"]) == (1, 1, "success")
    served = load_summary("dws_vip_order_source_di", tables.read("dws_vip_order_source_di"), DAYS[1]).first()
    assert (served["plan_id"], served["sex"], served["level"]) == ("", "unknown", -1)


def test_running_a_day_again_changes_nothing(spark, raw, tables, rows):
    names = ["dim_account_df", "dim_video_df", "dim_comment_df", "dws_video_stats_account_di", "dwd_action_video_di"]
    before = {n: rows(tables.read(n)) for n in names}
    run_day(spark, raw, tables.root, DAYS[2], f"{DAYS[2]} 23:59:00")
    assert {n: rows(tables.read(n)) for n in names} == before


def test_bucketed_snapshots_are_not_moved(spark, raw, tables, rows, tmp_path):
    """Three days with bucketed snapshots: the same rows, and a roll-forward that shuffles the changes only."""
    for n, day in enumerate(DAYS):
        done = run_day(spark, raw, str(tmp_path), day, f"{day} 23:59:00", bootstrap=n == 0, buckets=8)
    for name in ROLLED_KEYS:
        same = [c for c in done.scan_snapshot(name, DAYS[2]).columns if c != "dw_create_time"]
        assert rows(done.scan_snapshot(name, DAYS[2]).select(*same)) == rows(tables.scan_snapshot(name, DAYS[2]).select(*same))
        assert rows(Tables(spark, str(tmp_path)).scan_snapshot(name, DAYS[2]).select(*same)) == rows(tables.scan_snapshot(name, DAYS[2]).select(*same))
    before = done.scan_snapshot("dim_video_df", DAYS[1])
    made = dims.video_snapshot(
        DAYS[2], F.lit("2024-03-04").cast("timestamp"), dims.video_content(raw, DAYS[2]),
        done.scan_snapshot("dwd_stats_video_di", DAYS[2]).withColumn("dt", F.lit(DAYS[2])),
        stats.reply_counts(done.scan_snapshot("dwd_action_comment_di", DAYS[2]).withColumn("dt", F.lit(DAYS[2]))), before,
    )
    plan = made._jdf.queryExecution().executedPlan().toString()
    table = done._table("dim_video_df", DAYS[1])
    lines = plan.split("\n")
    scan = next(n for n, line in enumerate(lines) if table in line)
    depth = lines[scan].index("FileScan")
    above = [line for line in lines[:scan] if len(line) - len(line.lstrip(" :+-|")) < depth]
    join = max(n for n, line in enumerate(lines[:scan]) if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
    assert above and not any("Exchange" in line for line in lines[join:scan]), plan


def test_a_missing_day_before_is_an_error(spark, raw, tmp_path):
    with pytest.raises(MissingSnapshot):
        run_day(spark, raw, str(tmp_path), DAYS[1], f"{DAYS[1]} 23:59:00")


def test_a_half_written_day_counts_as_missing(spark, tables, tmp_path):
    other = Tables(spark, str(tmp_path))
    other.overwrite_partition(tables.scan_snapshot("dim_video_df", DAYS[0]), "dim_video_df", DAYS[0])
    assert other.has_day("dim_video_df", DAYS[0])
    (tmp_path / "dim_video_df" / f"dt={DAYS[0]}" / "_temporary").mkdir()
    assert not other.has_day("dim_video_df", DAYS[0])


def test_overwrite_days_leaves_other_days_alone(spark, tables, rows):
    other = spark.createDataFrame([(1, "BVx", 5, "2024-02-01")], "rpid bigint, oid string, like_count_delta int, dt string")
    before = rows(tables.read("dwd_stats_comment_di"))
    tables.overwrite_days(other, "dwd_stats_comment_di")
    tables.overwrite_days(other, "dwd_stats_comment_di")
    assert rows(tables.read("dwd_stats_comment_di").where("dt > '2024-02-01'")) == before
    assert tables.scan_snapshot("dwd_stats_comment_di", "2024-02-01").count() == 1


def test_days_back():
    assert days_back("2024-03-01", 2) == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_previous_pairs_without_relations_are_dropped(spark):
    schema = "mid bigint, target_mid bigint, event_id string"
    gone = relation_rollforward(None, spark.createDataFrame([(1, 2, "social_unfollow")], schema))
    assert gone.count() == 1
    assert relation_rollforward(gone, spark.createDataFrame([], schema)).count() == 0

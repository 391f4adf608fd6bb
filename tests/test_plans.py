"""The shape of physical plans: what is pruned, pushed, reduced early and shuffled."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.cumulate import cumulate
from tidemark.functions.json_paths import extract_json, json_fields
from tidemark.operators import relations
from tidemark.operators.enrich import left_enrich
from tidemark.operators.snapshots import fold_by_key, latest_by_key, merge_latest
from tidemark.plans import detail, dims, stats, summaries
from tidemark.session import shared_dir, spread


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|single|round)", physical(df), flags=re.IGNORECASE))


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def stored(spark, tmp_path, name, df):
    df.write.mode("overwrite").parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_json_is_parsed_once_under_a_filter(spark):
    df = spark.range(10).select(F.concat(F.lit('{"a":"'), "id", F.lit('"}')).alias("json_str"))
    rows = extract_json(df, json_fields("a bigint\nb string p.q")).where("a > 3 AND b IS NULL")
    assert physical(rows).count("from_json") == 1


def test_newest_row_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t", "CAST(id AS STRING) AS v")
    plan = physical(latest_by_key(df, ["k"], ["t"]))
    assert plan.index("WindowGroupLimit") and "Partial" in plan[plan.index("Exchange"):]


def test_distinct_viewers_are_spread_before_they_are_counted(spark, tmp_path):
    texts = ", ".join(f"CAST(id AS STRING) AS {c}" for c in ("dt", "event_id", "bvid"))
    df = stored(spark, tmp_path, "actions", spark.range(10).selectExpr("*", *texts.split(", "), "id AS mid", "id AS coin_count"))
    plan = physical(stats.video_stats(df))
    first = plan[plan.rindex("Exchange hashpartitioning"):].splitlines()[0]
    assert "mid" in first and "bvid" in first


def test_fold_by_key_moves_each_part_once(spark, no_broadcast):
    parts = {n: spark.range(9).selectExpr("id AS k", f"id AS {n}") for n in "ab"}
    parts["c"] = spark.range(9).selectExpr("id % 3 AS k", "id AS c").groupBy("k").agg(F.max("c").alias("c"))
    plan = physical(fold_by_key(parts, ["k"]))
    assert "Exchange" not in plan[: plan.index("Union")]
    assert exchanges(fold_by_key(parts, ["k"])) == 3


def test_fold_by_key_stays_whole_when_partitions_are_joined(spark, no_broadcast):
    big = spark.range(50_000).selectExpr("id % 20000 AS k", "repeat(CAST(id AS STRING), 5) AS v")
    big = big.groupBy("k").agg(F.max("v").alias("v"))
    small = spark.range(300).selectExpr("id * 100 AS k", "id AS w").groupBy("k").agg(F.max("w").alias("w"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        folded = fold_by_key({"big": big, "small": small}, ["k"])
        assert folded.count() == 20_100
        assert folded.where("big IS NOT NULL AND small IS NOT NULL").count() == 200
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def test_snapshot_meets_changes_in_one_join(spark, no_broadcast):
    old = spark.range(9).selectExpr("id AS k", "id AS t")
    assert exchanges(merge_latest(old, old, ["k"], "t")) == 2


def test_lists_join_without_moving_again(spark, tmp_path, no_broadcast):
    actions = spark.range(9).selectExpr("id AS mid", "id + 1 AS target_mid", "'social_follow' AS event_id")
    pairs = stored(spark, tmp_path, "pairs", relations.relation_rollforward(None, actions))
    counts = relations.relation_counts(pairs)
    folded = fold_by_key({"relations": counts}, ["mid"])
    joined = folded.join(relations.relation_lists(pairs, counts), "mid", "left")
    # One for the counts, one for the lists, one inside the broadcast set of large accounts.
    assert len(re.findall(r"Exchange hashpartitioning\(mid#", physical(joined))) == 3


def test_pairs_are_rolled_forward_by_pair_not_by_account(spark, no_broadcast):
    rows = spark.range(9).selectExpr("id AS mid", "id + 1 AS target_mid", "'social_follow' AS event_id")
    plan = physical(relations.relation_rollforward(relations.relation_rollforward(None, rows), rows))
    assert set(re.findall(r"hashpartitioning\((\w+)#\d+L, (\w+)#", plan)) == {("lo", "hi")}


def test_dimension_columns_are_pruned_at_the_scan(spark, tmp_path, no_broadcast):
    wide = spark.range(9).selectExpr("id AS mid", "'n' AS nick_name", "id AS a", "id AS b")
    dim = stored(spark, tmp_path, "dim", wide)
    plan = physical(left_enrich(spark.range(9).selectExpr("id AS mid"), dim, ["mid"], ["nick_name"]))
    assert "ReadSchema: struct<mid:bigint,nick_name:string>" in plan


def test_orders_of_one_buyer_are_reduced_before_the_join(spark, tmp_path, no_broadcast):
    columns = [f"id AS {c}" for c in ("mid", "dt", *summaries.ORDER_DIMS, *summaries.ORDER_AMOUNTS)]
    orders = stored(spark, tmp_path, "orders", spark.range(99).selectExpr(*columns))
    buyers = spark.range(3).selectExpr("id AS mid", *(f"id AS {c}" for c in summaries.BUYER_DIMS))
    accounts = stored(spark, tmp_path, "accounts", buyers)
    plan = physical(summaries.order_source(orders, accounts, F.current_timestamp()))
    assert plan.index("SortMergeJoin") < plan.rindex("partial_count")


def test_a_hot_key_is_split_in_joins(spark, no_broadcast):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        videos = spark.range(60_000).repartition(8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7L ELSE id END AS mid", "repeat(CAST(id AS STRING), 4) AS bvid"
        )
        accounts = spark.range(1_000).selectExpr("id AS mid", "'n' AS nick_name")
        joined = left_enrich(videos, accounts, ["mid"], ["nick_name"])
        assert len(joined.collect()) == 60_000
        assert "skew=true" in physical(joined)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_small_scans_are_spread_and_large_ones_left_alone(spark, tmp_path):
    table = stored(spark, tmp_path, "t", spark.range(100).coalesce(1))
    assert spread(table).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10")
    try:
        assert spread(table) is table
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_distinct_counts_of_windows_read_their_source_once(spark):
    events = spark.range(100).selectExpr("timestamp_seconds(id) AS at", "id % 3 AS a", "id % 5 AS b", "id % 2 AS k")
    made = cumulate(events, "at", "10 seconds", "1 minute", ["k"], {"n": F.lit(1)}, distincts={"as": "a", "bs": "b"}, firsts={"x": "a"})
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and "Union" not in plan and "Join" not in plan
    last = made.where("window_end = timestamp'1970-01-01 00:01:00' AND k = 0").first()
    assert (last["n"], last["as"], last["bs"], last["x"]) == (30, 3, 5, 0)


def test_accounts_parse_only_what_they_read_of_orders_and_social_events(spark):
    body = '{"event_id":"vip_pay_success","mid":1,"server_ts":5,"order_no":"a","properties":{"new_vip_expire":9,"plan_duration_days":31,"coupon_id":"c"}}'
    raw = spark.createDataFrame([(body, "d", t) for t in ("app_event_vip", "app_event_social")], "json_str string, dt string, topic string")
    whole, narrow = detail.vip_orders(raw), detail.vip_orders(raw, columns=dims.PAID_INPUT)
    assert dims.newest_paid_orders(narrow).collect() == dims.newest_paid_orders(whole).collect() != []
    assert "coupon_id" in physical(whole) and "coupon_id" not in physical(narrow)
    social = detail.account_actions(raw, columns=["mid", "target_mid"])
    assert social.select("event_id", "mid", "server_ts").collect() == [("vip_pay_success", 1, 5)]
    assert "device_info" not in physical(social)

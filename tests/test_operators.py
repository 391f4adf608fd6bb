from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cumulate, orders, relations, rows as row_ops, serving, snapshots
from tidemark.plans import dims


def test_quality_flags_name_the_first_missing_field(spark, rows):
    df = spark.createDataFrame([("e", 1), (None, 1), ("e", None), (None, None)], "event_id string, mid int")
    got = rows(row_ops.quality_flags(df, ["event_id", "mid"]), "is_valid", "invalid_reason")
    assert got == [(False, "missing_event_id"), (False, "missing_event_id"), (False, "missing_mid"), (True, None)]


def test_required_and_blank_ids(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, ""), (4, None)], "id int, no string")
    assert rows(row_ops.require(df, ("id",), ("no",))) == [(1, "a")]


def test_reply_events_are_credited_to_the_parent(spark, rows):
    df = spark.createDataFrame([("comment_reply", 1, 9), ("comment_like", 1, 9)], "event_id string, rpid int, parent_rpid int")
    assert rows(df.select(row_ops.normalize_reply_key())) == [(1,), (9,)]


def test_latest_by_key_takes_nulls_last_and_breaks_ties(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, None, "z"), (2, None, "q")], "k int, t int, v string")
    assert rows(snapshots.latest_by_key(df, ["k"], ["t", "v"])) == [(1, 5, "b"), (2, None, "q")]


def test_merge_latest_prefers_newer_and_change_on_ties(spark, rows):
    old = spark.createDataFrame([(1, 5, "old"), (2, 9, "old"), (3, 1, "old"), (4, None, "old")], "k int, t int, v string")
    new = spark.createDataFrame([(1, 5, "new"), (2, 8, "new"), (5, 1, "new"), (5, 2, "newer"), (4, None, "new")], "k int, t int, v string")
    want = [(1, 5, "new"), (2, 9, "old"), (3, 1, "old"), (4, None, "new"), (5, 2, "newer")]
    assert rows(snapshots.merge_latest(old, new, ["k"], "t")) == want


def test_same_comment_id_under_two_videos_stays_two_rows(spark, rows):
    old = spark.createDataFrame([(1, "BV1", 5, "a")], "rpid int, oid string, t int, v string")
    new = spark.createDataFrame([(1, "BV2", 6, "b")], "rpid int, oid string, t int, v string")
    assert rows(snapshots.merge_latest(old, new, ["rpid", "oid"], "t")) == [(1, "BV1", 5, "a"), (1, "BV2", 6, "b")]


def test_fold_by_key_equals_chain_of_outer_joins(spark, rows):
    a = spark.createDataFrame([(1, "a1"), (2, None)], "k int, x string")
    b = spark.createDataFrame([(2, 20), (3, 30)], "k int, y int")
    folded = snapshots.fold_by_key({"a": a, "b": b}, ["k"])
    got = rows(folded.select("k", "a.x", "b.y", F.col("a").isNotNull().alias("in_a")))
    assert got == [(1, "a1", None, True), (2, None, 20, True), (3, None, 30, False)]


def test_accumulate_snapshot_sums_several_delta_rows(spark, rows):
    old = spark.createDataFrame([("a", 5), ("b", None)], "k string, total int")
    delta = spark.createDataFrame([("a", -2), ("a", -4), ("c", 1)], "k string, d int")
    assert rows(snapshots.accumulate_snapshot(old, delta, ["k"], {"total": "d"})) == [("a", -1), ("b", 0), ("c", 1)]


def test_key_spine_and_new_keys(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, 0), (3, 0)], "k int, w int")
    assert rows(snapshots.key_spine(["k"], a, b)) == [(1,), (2,), (3,)]
    assert rows(snapshots.new_keys(a, b, ["k"])) == [(1, "x")]


# ---- relations


def actions(spark, *rows):
    return spark.createDataFrame(rows, "mid bigint, target_mid bigint, event_id string, server_ts bigint")


def model(previous, events):
    """The list algebra per account: (yesterday or added) and not removed."""
    state = defaultdict(set)
    for name, pairs in previous.items():
        state[name] |= pairs
    names = {"following": ("social_follow", "social_unfollow"), "blocking": ("social_block", "social_unblock")}
    for name, (add, remove) in names.items():
        added = {(m, t) for m, t, e, _ in events if e == add}
        removed = {(m, t) for m, t, e, _ in events if e == remove}
        state[name] = (state[name] | added) - removed
    return state


def test_relations_match_set_algebra_over_random_days(spark):
    rng = random.Random(7)
    names = ["social_follow", "social_unfollow", "social_block", "social_unblock", "social_whisper"]
    pairs, state = None, {}
    for _ in range(3):
        events = [(rng.randrange(8), rng.randrange(8), rng.choice(names), 1) for _ in range(60)]
        pairs = relations.relation_rollforward(pairs, actions(spark, *events))
        pairs = spark.createDataFrame(pairs.collect(), relations.PAIR_SCHEMA)
        state = model(state, events)
    counts = relations.relation_counts(pairs)
    lists = {r["mid"]: r for r in relations.relation_lists(pairs, counts).collect()}
    sizes = {r["mid"]: r for r in counts.collect()}
    rows = [(r["mid"], f"{r['relation']}_list", r["other"]) for r in relations.relation_members(pairs).collect()]
    for me in range(8):
        following = {t for m, t in state["following"] if m == me}
        followers = {m for m, t in state["following"] if t == me}
        want = {
            "following_list": following, "follower_list": followers, "mutual_follow_list": following & followers,
            "blocking_list": {t for m, t in state["blocking"] if m == me},
            "blocked_by_list": {m for m, t in state["blocking"] if t == me},
        }
        for name, members in want.items():
            got = lists[me][name] if me in lists else []
            assert got == sorted(members)
            assert sorted(o for m, n, o in rows if m == me and n == name) == sorted(members)
            assert (sizes[me][name.replace("_list", "_cnt")] if me in sizes else 0) == len(members)
        changes = {e: {(m, t) for m, t, ev, _ in events if ev == e} for e in names}
        gained = len([1 for m, t in changes["social_follow"] if m == me]) - len([1 for m, t in changes["social_unfollow"] if m == me])
        assert (sizes[me]["following_chg"] if me in sizes else 0) == gained


def test_follow_unfollow_follow_ends_unfollowed_unless_ordered(spark):
    day = actions(spark, (1, 2, "social_follow", 1), (1, 2, "social_unfollow", 2), (1, 2, "social_follow", 3))
    assert relations.live_pairs(relations.relation_rollforward(None, day)).count() == 0
    kept = relations.live_pairs(relations.relation_rollforward(None, day, ordered=True)).first()
    assert kept["follow_fwd"] and not kept["follow_bwd"]


def test_large_accounts_have_their_lists_in_chunks(spark):
    """One account is in nearly half of all pairs."""
    star = [(n, 0, "social_follow", 1) for n in range(1, 400)] + [(0, n, "social_follow", 1) for n in range(1, 400, 3)]
    star += [(n, n + 1, "social_follow", 1) for n in range(1, 300)] + [(0, 500, "social_block", 1)]
    pairs = relations.relation_rollforward(None, actions(spark, *star))
    counts = relations.relation_counts(pairs)
    chunks = relations.relation_chunks(pairs, counts, 10).collect()
    whole = sum(counts.where("mid = 0").first()[f"{name}_cnt"] for name in relations.LISTS)
    own = [r for r in chunks if r.mid == 0]
    assert {r.chunks for r in own} == {-(-whole // 10)} and len(own) > whole // 20
    assert max(sum(len(r[f"{name}_list"]) for name in relations.LISTS) for r in own) < 40
    small = {r["mid"] for r in relations.relation_lists(pairs, counts, inline_limit=10).collect()}
    large = {r["mid"] for r in dims.large_account_lists(pairs, 10).collect()}
    assert 0 in large and not small & large and small | large == {*range(0, 400), 500}
    members = relations.relation_members(pairs)
    every = relations.chunk_members(spark.createDataFrame(chunks, relations.relation_chunks(pairs, counts, 10).schema))
    want = sorted(map(tuple, members.collect()))
    assert sorted(map(tuple, every.collect())) == want and len(want) > 1500
    mutual = [sorted(o for r in own for o in r["mutual_follow_list"])]
    assert mutual == [list(range(1, 400, 3))]
    plan = relations.relation_chunks(pairs, counts, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "Broadcast" not in plan
    assert "Exchange" not in relations.relation_members(
        spark.createDataFrame(pairs.collect(), relations.PAIR_SCHEMA)
    )._jdf.queryExecution().executedPlan().toString()


def test_pairs_from_stored_lists(spark, rows):
    accounts = spark.createDataFrame(
        [(1, [2, 3], [3]), (2, [1], []), (3, [], None)],
        "mid bigint, following_list array<bigint>, blocking_list array<bigint>",
    )
    got = rows(relations.pairs_from_lists(accounts), "lo", "hi", "follow_fwd", "follow_bwd", "block_fwd", "chg_fwd")
    assert got == [(1, 2, True, True, False, 0), (1, 3, True, False, True, 0)]


# ---- orders


def test_order_status_priority_and_milestones(spark, rows):
    events = [
        ("a", "vip_pay_success", 9, "p"), ("a", "vip_pay_fail", 10, "q"), ("a", "vip_create_order", 3, None),
        ("a", "vip_create_order", 2, None), ("b", "vip_pay_start", 5, None), ("c", "vip_create_order", 1, "z"),
        ("d", "vip_pay_cancel", 4, None), ("d", "vip_pay_start", 3, None), ("e", None, None, None),
    ]
    df = spark.createDataFrame(events, "order_no string, event_id string, server_ts bigint, plan_id string")
    got = rows(orders.accumulate_order(df, ["order_no"]), "order_no", "order_status", "create_ts", "pay_end_ts", "plan_id")
    assert got == [
        ("a", "success", 2, 10, "q"), ("b", "paying", None, None, None), ("c", "created", 1, None, "z"),
        ("d", "cancel", None, 4, None), ("e", "created", None, None, None),
    ]
    newest = {r["order_no"]: r["plan_id"] for r in orders.accumulate_order(df, ["order_no"], newest=True).collect()}
    assert newest["a"] == "q"


# ---- cumulative windows


def brute_force(events, step, size, dense):
    """Every event is in all windows of its size window that end after it."""
    out = {}
    for key, at, who in events:
        base = at - at % size
        end = base + step
        while end <= base + size:
            if end > at:
                n, seen, top = out.get((key, base, end), (0, frozenset(), -1))
                out[(key, base, end)] = (n + 1, seen | {who}, max(top, who))
            end += step
    kept = {
        k: (n, len(seen), top)
        for k, (n, seen, top) in out.items()
        if dense or any(key == k[0] and at - at % step + step == k[2] for key, at, _ in events)
    }
    return sorted((k, s, e, *v) for (k, s, e), v in kept.items())


@pytest.mark.parametrize("dense", [True, False])
def test_cumulate_matches_brute_force(spark, dense):
    rng = random.Random(3)
    events = [(rng.choice("ab"), rng.randrange(0, 400), rng.randrange(6)) for _ in range(80)]
    df = spark.createDataFrame(events, "k string, s bigint, who int").withColumn("at", F.timestamp_seconds("s"))
    got = cumulate.cumulate(
        df, "at", "20 seconds", "100 seconds", ["k"], sums={"n": F.lit(1)}, maxima={"top": F.col("who")},
        distincts={"people": "who"}, dense=dense,
    ).select("k", F.unix_timestamp("window_start"), F.unix_timestamp("window_end"), "n", "people", "top")
    assert sorted(tuple(r) for r in got.collect()) == brute_force(events, 20, 100, dense)


def test_day_windows_of_a_zone_east_of_utc(spark):
    times = [dt.datetime(2024, 1, 1, 15, 59, 59), dt.datetime(2024, 1, 1, 16, 0, 0)]
    df = spark.createDataFrame([(t.replace(tzinfo=dt.timezone.utc),) for t in times], "at timestamp")
    final = cumulate.cumulate_final(df, "at", "1 day", [], [F.count("*").alias("n")], cumulate.utc_offset_start(8))
    starts = sorted(r[0] for r in final.select(F.date_format("window_start", "dd HH:mm")).collect())
    assert starts == ["01 16:00", "31 16:00"]


# ---- serving


def test_latest_version_and_unify(spark, rows):
    batch = spark.createDataFrame([(1, "b", 5)], "k int, v string, dw_create_time int")
    speed = spark.createDataFrame([(1, "s", 5), (2, "s", 1), (2, "t", 2)], "k int, v string, dw_create_time int")
    assert rows(serving.unify_batch_speed(batch, speed, ["k"])) == [(1, "b", 5), (2, "t", 2)]


def test_fresh_rows_drop_null_and_newer(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-29"), (2, "2024-01-31"), (3, None)], "k int, d string")
    assert rows(serving.fresh_rows(df, F.col("d"), "2024-01-30"), "k") == [(1,)]


def test_lookup_entity_by_reversed_key_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.createDataFrame([("021", "a"), ("7", "b")], "rowkey string, v string").write.parquet(path)
    found = serving.lookup_entity(spark.read.parquet(path), 120)
    assert [r["v"] for r in found.collect()] == ["a"]
    assert "EqualTo(rowkey,021)" in found._jdf.queryExecution().executedPlan().toString()


def test_pack_and_unpack_families(spark, rows):
    df = spark.createDataFrame([(12, "n", True)], "id bigint, name string, ok boolean")
    packed = serving.pack_families(df, F.lit("21"), {"a": {"id": F.col("id")}, "b": {"name": F.col("name"), "ok": F.col("ok")}})
    assert packed.schema["b"].dataType.simpleString() == "struct<name:string,ok:string>"
    flat = serving.unpack_families(packed, {"id": ("a.id", "bigint"), "ok": ("b.ok", "boolean"), "bad": ("b.name", "int")})
    assert rows(flat) == [("21", 12, True, None)]

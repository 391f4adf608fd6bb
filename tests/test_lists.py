from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import relations
from tidemark.plans import dims, serving


def test_lists_of_many_chunks_are_whole(spark):
    star = [(n, 0, "social_follow") for n in range(1, 200)] + [(0, n, "social_follow") for n in range(1, 200, 3)]
    star += [(n, n + 1, "social_block") for n in range(150)]
    pairs = relations.relation_rollforward(None, spark.createDataFrame(star, "mid bigint, target_mid bigint, event_id string"))
    rows = relations.relation_lists(pairs, relations.relation_counts(pairs), chunk_ids=10).collect()
    assert len(rows) == len({r.mid for r in rows}) == 200
    got = [(r.mid, name, other) for r in rows for name in relations.LISTS for other in r[f"{name}_list"]]
    assert sorted(got) == sorted(map(tuple, relations.relation_members(pairs).collect()))
    assert all(list(r[f"{name}_list"]) == sorted(r[f"{name}_list"]) for r in rows for name in relations.LISTS)


def test_wide_row_of_a_very_large_account_has_every_member(spark):
    """One account has more relations than a chunk holds."""
    size, day = relations.CHUNK_IDS + 50, "2024-01-30"
    pairs = spark.range(1, size + 1).selectExpr(
        "0L AS lo", "id AS hi", "id % 1000 = 0 AS follow_fwd", "true AS follow_bwd", "false AS block_fwd",
        "id % 500 = 0 AS block_bwd", "0 AS chg_fwd", "0 AS chg_bwd",
    )
    message = ('{"mid":0,"updated_at":1706529600000}', day, "app_user_profile")
    profile = dims.profiles(spark.createDataFrame([message], "json_str string, dt string, topic string"), day)
    orders = spark.createDataFrame(
        [], "mid bigint, order_no string, order_status string, new_vip_expire_ts bigint, plan_duration_days int, pay_end_ts bigint"
    )
    accounts = dims.account_snapshot(day, F.lit(f"{day} 23:59:00").cast("timestamp"), profile, pairs, orders, None)
    [large] = serving.account_rows(accounts, day).select("relation.*").collect()

    def text(members):
        return "[" + ", ".join(map(str, members)) + "]"

    assert large.follower_cnt == str(size) and large.follower_list == text(range(1, size + 1))
    assert large.following_list == large.mutual_follow_list == text(range(1000, size + 1, 1000))
    assert large.blocked_by_list == text(range(500, size + 1, 500)) and large.blocking_list == "[]"
    assert relations.relation_lists(pairs, relations.relation_counts(pairs)).count() == size + 1

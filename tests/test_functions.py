from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import casts, derive, json_paths, labels, metrics


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}")


@pytest.mark.parametrize(
    ("text", "want"),
    [("12", 12), (" 12 ", 12), ("12.7", 12), ("-3.9", -3), ("abc", None), ("", None), (None, None), ("1e30", None)],
)
def test_whole_numbers_from_text(spark, text, want):
    assert one(spark, text).select(casts.as_whole("x")).first()[0] == want


@pytest.mark.parametrize(("text", "want"), [("TRUE", True), ("False", False), ("yes", None), ("1", None), (None, None)])
def test_only_the_words_true_and_false_are_flags(spark, text, want):
    assert one(spark, text).select(casts.parse_bool_ci("x")).first()[0] is want


@pytest.mark.parametrize(("text", "want"), [("1704067199999", "2023-12-31 23:59:59"), ("17x", None), ("", None), (None, None)])
def test_digits_guard_before_time(spark, text, want):
    got = one(spark, text).select(F.date_format(casts.digits_ms_to_timestamp("x"), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert got == want


def test_json_extraction_covers_missing_bad_and_nested(spark, rows):
    messages = [
        ('{"event_id":"e1","mid":"7","p":{"n":"12.5","flag":"TRUE","deep":{"a":[1,2]}}}',),
        ('{"event_id":null,"mid":"x","p":{"n":true,"flag":"maybe"}}',),
        ("{broken",),
        ('{"p":"text"}',),
        (None,),
    ]
    df = spark.createDataFrame(messages, "json_str string")
    fields = json_paths.json_fields(
        "event_id string\nmid bigint\nn double p.n\nflag flag p.flag\nlist string p.deep.a\nwhole string p"
    )
    got = json_paths.extract_json(df, fields).collect()
    assert [r["event_id"] for r in got] == ["e1", None, None, None, None]
    assert [r["mid"] for r in got] == [7, None, None, None, None]
    assert [r["n"] for r in got] == [12.5, None, None, None, None]
    assert [r["flag"] for r in got] == [True, None, None, None, None]
    assert got[0]["list"] == "[1,2]"
    assert got[0]["whole"] == '{"n":"12.5","flag":"TRUE","deep":{"a":[1,2]}}'
    assert got[3]["whole"] == "text"


def test_json_decimal_and_int_types(spark):
    df = spark.createDataFrame([('{"c":1234.5,"i":3}',)], "json_str string")
    row = json_paths.extract_json(df, json_paths.json_fields("c decimal(12,2)\ni int")).first()
    assert row["c"] == Decimal("1234.50") and row["i"] == 3


def test_labels_and_status(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (9,), (None,)], "c int")
    got = [r[0] for r in df.select(labels.vip_type_name(F.col("c"))).collect()]
    assert got == ["普通用户", "月度大会员", "年度大会员", "未知", "未知"]
    events = spark.createDataFrame([("vip_pay_fail",), ("other",), (None,)], "e string")
    assert [r[0] for r in events.select(labels.event_to_status(F.col("e"))).collect()] == ["fail", "unknown", "unknown"]
    plans = spark.createDataFrame([("monthly",), ("auto_monthly",), ("yearly",), (None,)], "p string")
    assert [r[0] for r in plans.select(labels.vip_type_from_plan(F.col("p"))).collect()] == [1, 1, 2, 2]


@pytest.mark.parametrize(
    ("birthday", "by_days", "by_calendar", "year"),
    [
        ("2000-01-30", 24, 24, 2000), ("2000-01-31", 23, 23, 2000), ("2001-02-31", None, None, 2001),
        ("1990/01/01", None, None, None), ("", None, None, None), (None, None, None, None),
    ],
)
def test_ages(spark, birthday, by_days, by_calendar, year):
    as_of = F.lit("2024-01-30")
    row = one(spark, birthday).select(
        derive.age_by_days(F.col("x"), as_of), derive.age_by_calendar(F.col("x"), as_of), derive.birth_year(F.col("x"))
    ).first()
    assert tuple(row) == (by_days, by_calendar, year)


@pytest.mark.parametrize(
    ("text", "want"),
    [(None, []), ("", []), ("[]", []), ('["a","b"]', ["a", "b"]), ('["x, y"]', ["x, y"]), ("[broken", [])],
)
def test_tags(spark, text, want):
    assert one(spark, text).select(derive.tag_array(F.col("x"))).first()[0] == want


def test_array_text_and_reverse_key(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<bigint>")
    assert [r[0] for r in df.select(derive.array_text(F.col("a"))).collect()] == ["[1, 2]", "[]", "[]"]
    assert one(spark, 120, "bigint").select(derive.reverse_key(F.col("x"))).first()[0] == "021"


def test_json_text_escapes(spark):
    got = one(spark, 'a"b').select(derive.json_text(t=F.col("x"), n=F.lit(0))).first()[0]
    assert got == '{"t":"a\\"b","n":0}'


END = int(dt.datetime(2024, 1, 30, 23, 59, 59, tzinfo=dt.timezone.utc).timestamp())


@pytest.mark.parametrize(
    ("new_s", "days", "old_s", "old_type", "want_s", "want_type"),
    [
        (END + 1, 31, None, None, END + 1, 1),
        (END + 1, 32, END - 9, 1, END + 1, 2),
        (END + 1, 93, None, None, END + 1, 2),
        (END, 31, END + 99, 2, END, 0),
        (None, None, END + 1, 2, END + 1, 2),
        (None, None, END, 2, END, 0),
        (None, None, None, None, None, 0),
    ],
)
@pytest.mark.parametrize("unit", ["ms", "s"])
def test_vip_state_by_unit(spark, new_s, days, old_s, old_type, want_s, want_type, unit):
    new = None if new_s is None else new_s * (1000 if unit == "ms" else 1)
    old = None if old_s is None else dt.datetime.fromtimestamp(old_s)
    df = spark.createDataFrame([(new, days, old_type)], "n bigint, d int, t int")
    old_column = F.lit(None).cast("timestamp") if old is None else F.timestamp_seconds(F.lit(old_s))
    expire, kind = derive.vip_state("2024-01-30", F.col("n"), F.col("d"), old_column, F.col("t"), unit)
    row = df.select(F.unix_timestamp(expire), kind).first()
    assert tuple(row) == (want_s, want_type)


def test_metrics_negative_net_and_safe_ratio(spark):
    events = ["video_unlike", "video_unlike", "video_like", "video_triple", "video_coin", "x"]
    df = spark.createDataFrame([(e, None) for e in events], "event_id string, coin_count int")
    batch = df.agg(*metrics.interaction_metrics(False)).first().asDict()
    speed = df.agg(*metrics.interaction_metrics(True)).first().asDict()
    assert (batch["net_like_delta"], speed["net_like_delta"]) == (-1, 0)
    assert (batch["coin_total_delta"], speed["coin_total_delta"]) == (1, 3)
    assert (batch["favorite_count_delta"], speed["favorite_count_delta"]) == (0, 1)
    ratios = spark.createDataFrame([(7, 2), (7, 0)], "a bigint, b bigint")
    assert [r[0] for r in ratios.select(metrics.whole_ratio(F.col("a"), F.col("b"))).collect()] == [3, None]

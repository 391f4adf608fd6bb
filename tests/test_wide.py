"""Wide tables in key buckets: compaction, hand-over, reads of some buckets."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidemark.session import spread, work_path
from tidemark.sources import changelog
from tidemark.sources.wide import WideTable, bucket_of

SOURCES = ["a", "b"]


def batch(spark, family, *rows):
    """Rows (key, version, value) as a batch of one family."""
    made = spark.createDataFrame(list(rows), "rowkey string, version long, v string")
    return made.select("rowkey", "version", F.struct(F.col("v").alias(family)).alias(f"f_{family}"))


@pytest.fixture
def table(spark):
    return WideTable(work_path(spark, "wide"), buckets=8)


def seen(df):
    return sorted((r.rowkey, r.version, r.f_x.x, r.f_y.y if "f_y" in r else None) for r in df.collect())


def pruned_to(df):
    """The buckets that the scan of the base is cut to before any file is opened; None if it is not cut."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    found = re.findall(r"PartitionFilters: \[(?:isnotnull\(bucket#\d+\), )?\(?bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", plan)
    return {n for many, one in found for n in (many or one).split(",")} or None


def test_compaction_changes_nothing_that_readers_see(spark, table):
    steps = [
        ("a", 0, batch(spark, "x", ("k1", 10, "old"), ("k2", 20, "x2"))),
        ("b", 0, batch(spark, "y", ("k1", 15, "y1"), ("k3", 5, "y3"))),
        ("a", 1, batch(spark, "x", ("k1", 12, "new"), ("k4", 1, None))),
        ("b", 1, batch(spark, "y", ("k1", 11, "late"))),
        ("a", 2, batch(spark, "x", ("k1", 12, "tie"), ("k2", 19, "behind"))),
    ]
    plain = work_path(spark, "plain")
    for n, (source, batch_id, rows) in enumerate(steps):
        table.upsert(source)(rows, batch_id)
        changelog.upsert_columns(plain, source)(rows, batch_id)
        if n:
            want = seen(changelog.read_columns(spark, plain, SOURCES))
            assert seen(table.read(spark, SOURCES)) == want
            assert table.compact(spark, SOURCES, open_batches=n % 2) == n
            assert seen(table.read(spark, SOURCES)) == want
    assert ("k1", 15, "tie", "y1") in want and ("k2", 20, "x2", None) in want
    assert table.generation(spark) == (4, {"a": 2, "b": 1})
    table.upsert("b")(batch(spark, "y", ("k1", 14, "between"), ("k2", 30, "y2")), 2)
    assert ("k1", 15, "tie", "y1") in seen(table.read(spark, SOURCES)) and ("k2", 30, "x2", "y2") in seen(table.read(spark, SOURCES))


def test_a_compaction_that_was_not_committed_is_not_read(spark, table):
    table.upsert("a")(batch(spark, "x", ("k", 1, "right")), 0)
    table.compact(spark, ["a"], open_batches=0)
    stray = batch(spark, "x", ("k", 9, "stray")).withColumn("batch_id", F.lit(0).cast("int"))
    stray = stray.withColumn("bucket", bucket_of(F.col("rowkey"), 8))
    stray.write.partitionBy("bucket").parquet(f"{table.path}/base/generation=2/source=a")
    assert seen(table.read(spark, ["a"])) == [("k", 1, "right", None)]
    assert table.compact(spark, ["a"]) == 2 and seen(table.read(spark, ["a"])) == [("k", 1, "right", None)]


def test_lookups_read_the_buckets_of_their_keys_only(spark, table):
    rows = [(f"k{n}", n, f"v{n}") for n in range(200)]
    table.upsert("a")(batch(spark, "x", *rows), 0)
    table.compact(spark, ["a"], open_batches=0)
    table.upsert("a")(batch(spark, "x", ("k7", 900, "newer"), ("k8", 900, "other")), 1)
    assert pruned_to(table.read(spark, ["a"])) is None
    keys = spark.createDataFrame([("k7",), ("k7",), ("none",), (None,)], "rowkey string")
    found = table.read_for(keys, ["a"])
    wanted = {str(r[0]) for r in keys.where("rowkey IS NOT NULL").select(bucket_of(F.col("rowkey"), 8)).collect()}
    assert len(wanted) == 2 and wanted <= pruned_to(found) <= wanted | {str(spark.range(1).select(bucket_of(F.lit(None).cast("string"), 8)).first()[0])}
    read = table._parts(spark, "a", 1, 0, buckets=[3]).where("batch_id = 0").select(F.input_file_name()).distinct()
    assert all("bucket=3/" in row[0] for row in read.collect())
    assert ("k7", 900, "newer", None) in seen(found)
    one = table.entity(spark, "k42", ["a"])
    assert seen(one) == [("k42", 42, "v42", None)] and len(pruned_to(one)) == 1
    assert "EqualTo(rowkey,k42)" in one._jdf.queryExecution().executedPlan().toString()
    assert seen(table.entity(spark, "k7", ["a"])) == [("k7", 900, "newer", None)] and table.entity(spark, "zz", ["a"]).count() == 0


def test_reading_a_table_that_nothing_has_written(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read(spark, SOURCES)
    assert table.compact(spark, SOURCES) == 1
    with pytest.raises(FileNotFoundError):
        table.read(spark, SOURCES)


def test_wide_rows_fold_a_row_per_source(spark, tmp_path):
    """One aggregate per source, not one per column; columns that two sources write go by version."""
    kinds = "rowkey string, version bigint, a struct<x:string,y:string>, b struct<z:string>"
    one = spark.createDataFrame([("k", 1, ("old", "y1"), ("z1",)), ("k", 5, ("x5", None), ("z5",)), ("l", None, ("n", "n"), ("n",))], kinds)
    two = spark.createDataFrame([("k", 7, (None, "y7")), ("m", 2, ("x2", "y2"))], "rowkey string, version bigint, a struct<x:string,w:string>")
    folded = changelog.fold_columns({"one": one, "two": two})
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("max_by(") == 2
    got = {r.rowkey: (r.version, r.a.asDict(), r.b.z) for r in folded.collect()}
    assert got == {
        "k": (7, {"x": None, "y": None, "w": "y7"}, "z5"),
        "l": (None, {"x": "n", "y": "n", "w": None}, "n"),
        "m": (2, {"x": "x2", "y": None, "w": "y2"}, None),
    }


def test_a_small_stream_is_dealt_over_the_cores(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(10).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema("id bigint").parquet(path)
    plan = spread(stream, spark.read.parquet(path))._jdf.queryExecution().logical().toString()
    assert plan.lstrip("~").startswith(f"Repartition {spark.sparkContext.defaultParallelism}, true")

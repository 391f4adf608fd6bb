"""Exact deduplication: a tree merge of sorted digest runs.

Every scan task makes one run: the digests of its texts, each with the smallest identifier that the
task has seen. Runs are merged in binomial rounds. In each round ``fan_in`` neighbouring runs meet;
what is exchanged is dealt out by (merged run, digest), so a round's work is spread over all tasks
and a digest that a third of all rows carry arrives once per run, not once per row. Only digests
move, never texts. On the way back the answer of a digest goes to its runs and from each run to that
run's own rows, so no task ever holds the rows of a large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, stored, text_or_empty

FAN_IN = 8
# Texts count as equal when digest, length and a second hash agree.
IDENTITY = ["sha", "n_bytes", "second"]


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(column), SPACE, " ")


def digest_rows(docs: DataFrame) -> DataFrame:
    """One row per document: its identity, its run, and a rank by which the smallest id is found."""
    with_text = docs.select("doc_id", normalised().alias("norm"))
    return with_text.select(
        "doc_id",
        F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"),
        F.octet_length("norm").cast("long").alias("n_bytes"),
        F.xxhash64("norm").alias("second"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
    )


def _rank() -> Column:
    """Orders identifiers; rows without an id come last, repeated rows by their place."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("row"))


def _merge(runs: DataFrame) -> DataFrame:
    merged = runs.groupBy("run", *IDENTITY).agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
    return merged.sortWithinPartitions("run", "sha")


def tree_merge(runs: DataFrame, n_runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """Sorted runs (``run``, identity, ``first``, ``copies``) merged into one, round by round."""
    while n_runs > 1:
        runs = _merge(runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")))
        n_runs = -(-n_runs // fan_in)
    return runs


def exact_groups(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: doc_id, sha, keep_id, group_size, kept.

    Null and empty texts form one group; a text of white space only equals a single space. Of rows
    with equal text the smallest doc_id stays; null ids lose to all others; of repeated rows (same id,
    same text) one stays. An empty table gives no rows. Other columns are not read.
    """
    rows = stored(digest_rows(docs), "digests")
    last = rows.agg(F.max("run")).first()[0]
    runs = _merge(rows.select("run", *IDENTITY, _rank().alias("first"), F.lit(1).cast("long").alias("copies")))
    whole = tree_merge(runs, (last or 0) + 1, fan_in).select(
        *IDENTITY, F.col("first").alias("keep"), F.col("copies").alias("group_size")
    )
    answers = runs.select("run", *IDENTITY).join(whole, IDENTITY)
    return rows.join(answers, ["run", *IDENTITY]).select(
        "doc_id",
        "sha",
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
    )


def deduplicate(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows are found again by id and digest. Repeated rows share both; of them one is taken, by an
    aggregation that is combined before its shuffle.
    """
    groups = exact_groups(docs, fan_in)
    own = [F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns)).alias("doc")]
    rows = docs.select(
        F.col("doc_id").alias("own_id"), F.unhex(F.sha2(normalised().cast("binary"), 256)).alias("own_sha"), *own
    )
    stay = stored(groups.groupBy("doc_id", "sha").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")), "kept")
    stay = stay.where("kept")

    def matched(keys: DataFrame) -> DataFrame:
        return rows.join(
            keys.select("doc_id", "sha"),
            F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_sha") == F.col("sha")),
            "left_semi",
        )

    single = matched(stay.where("rows = 1")).select("doc")
    if not stay.where("rows > 1").isEmpty():
        repeated = matched(stay.where("rows > 1"))
        single = single.unionByName(repeated.groupBy("own_id", "own_sha").agg(F.first("doc").alias("doc")).select("doc"))
    return single.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def op7_exact_dedup(docs: DataFrame) -> DataFrame:
    return exact_groups(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, d.text_sha256
FROM d JOIN g ON d.text_sha256 = g.text_sha256
"""

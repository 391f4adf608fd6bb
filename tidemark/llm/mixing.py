"""Mixing sources to target weights by hash-random keys and distributed prefix sums.

Every document gets a random key from a hash. Keys are uniform, so their leading bits cut each
source into equal ranges without sampling. Sizes are summed per source and range, a running sum over
that small table gives each range its start, and the running sum within a range gives each document
its interval on the source's line of words. A target of T words over a source of S words is T div S
whole epochs plus the documents on the first T mod S words of the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, stored, text_or_empty

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
ROWS_PER_RANGE = 20_000
SEED = "mix"


def n_words(column: str = "text") -> Column:
    return F.size(F.array_remove(F.split(text_or_empty(column), SPACE), "")).cast("long")


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size and key. The key depends on id and text alone, so reruns agree."""
    text = text_or_empty()
    identity = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    return docs.select("doc_id", "source", n_words().alias("size"), F.md5(identity).alias("key"))


def source_targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size and target.

    Weights go round the sources in code point order, null last. A target stops at ``max_epochs``
    times its source; the rest is shared again by weight. Sources are ordered by how soon they fill
    up; those that do are the first k, and the level of the others follows from what the k leave.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = totals.withColumn("n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("n") % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * max_epochs).cast("double")
    ranked = numbered.select("source", "source_size", "n", weight.alias("weight"), limit.alias("limit"))
    soonest = Window.orderBy(F.col("limit") / F.col("weight"), "n")
    before = soonest.rowsBetween(Window.unboundedPreceding, -1)
    after = soonest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    levels = ranked.withColumn("level", left / F.sum("weight").over(after))
    stands = levels.withColumn("open", F.col("limit") >= F.col("weight") * F.col("level"))
    level = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        soonest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(F.col("limit"), F.coalesce(F.col("weight") * level, F.col("limit")))
    return stands.select("source", "source_size", target.alias("target"))


def mixture(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """One row per document: doc_id, source, key, size, source_size, target and taken.

    ``taken`` counts words with repeats; the document on which the budget ends gives just the words
    up to it, so a source's taken words are its target rounded down. Null and empty texts have size 0
    and are taken 0 times; a source of such texts only has target 0. Null is a source of its own.
    Repeated rows have equal keys and lie side by side. An empty table gives no rows.
    """
    rows = stored(sized(docs, seed), "sizes")
    bits = max(0, (max(1, rows.count()) // ROWS_PER_RANGE).bit_length())
    leading = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("range", F.shiftright(leading, 32 - bits) if bits else F.lit(0).cast("long"))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges.withColumnRenamed("range_size", "size"), weights, max_epochs)
    line = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(line), F.lit(0).cast("long")))
    known = starts.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        F.col("s.source").alias("of"), F.col("range").alias("at"), "range_start", "source_size", "target"
    )
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
    placed = rows.withColumn(
        "place", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    )
    placed = placed.join(known, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("at")))
    budget = F.floor("target").cast("long")
    epochs = F.expr("CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) DIV source_size ELSE 0 END")
    rest = budget - epochs * F.col("source_size") - F.col("range_start") - F.col("place")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select("doc_id", "source", "key", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed corpus: each document as many times as it is taken, with all its columns.

    A document is whole in every copy; the one on which a budget ends is in when at least half of it
    is within the budget. Documents without words are in no mix. Repeated rows share their key; each
    of them gets the mean of their shares, rounded.
    """
    plan = mixture(docs, weights, max_epochs).where("size > 0").groupBy("key").agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias("copies")
    )
    plan = plan.where("copies > 0").select(F.col("key").alias("wanted"), "copies")
    text = text_or_empty()
    identity = F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    rows = docs.select(F.md5(identity).alias("own"), whole).join(plan, F.col("own") == F.col("wanted"))
    repeated = rows.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return repeated.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def op8_mixing(docs: DataFrame) -> DataFrame:
    return mixture(docs).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, size,
         md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), md5(body))) AS key
  FROM (
    SELECT doc_id, source, coalesce(text, '') AS body,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
  )
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n
  FROM d GROUP BY source
), w AS (
  SELECT *, CAST(n % 3 + 1 AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS lim FROM s
), l AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(lim) OVER (ORDER BY lim / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY lim / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM w
), t AS (
  SELECT source, source_size,
         least(lim, coalesce(weight * (
           SELECT lev FROM l AS o WHERE o.lim >= o.weight * o.lev ORDER BY o.lim / o.weight, o.n LIMIT 1), lim)) AS target
  FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS BIGINT) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - place)) END AS BIGINT) AS taken
FROM p
"""

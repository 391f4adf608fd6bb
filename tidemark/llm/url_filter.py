"""URL filter: rules first, then a likelihood ratio of two character models.

Urls that a rule judges train the method: one smoothed variable-order Markov model for those allowed
and one for those blocked, from all of them and whole. A url's measure is the difference of its two
log-likelihoods divided by its length; a logistic curve fitted on urls kept out of the counts turns
it into the probability that the url would be allowed.

The models are tables, not objects: counts of grams, totals and kinds of their contexts, and chances
worked out from shorter to longer grams by joins, for just those grams that some url has. Nothing of
them is broadcast or collected, so no gram is left out whatever their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_fold, slices, stored

# The rules, as verdict and host with path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"

ORDER = 4
SYMBOLS = 256
# Bound of the calibration sample.
CALIBRATION_ROWS = 20_000
CALIBRATION_FOLDS = 5
GRAM_BYTES = 1 << 18
FIRST, LAST = "\x02", "\x03"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for urls without ``://``."""
    safe = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(safe, PARTS, 1), UPPER, LOWER)
    return host, F.regexp_extract(safe, PARTS, 2)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def last_grams(text: str, order: int = ORDER) -> Counter:
    """Every symbol with up to ``order`` symbols before it, and how often."""
    marked = FIRST + text + LAST
    return Counter(marked[max(0, at - order) : at + 1] for at in range(1, len(marked)))


def text_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(id, gram, times, allow, block) of every text (``id``, ``text``, ``allow``, ``block``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", GRAM_BYTES):
                rows, grams, times = [], [], []
                for row, text in enumerate(part.column(1).to_pylist()):
                    found = last_grams(text, order)
                    rows += [row] * len(found)
                    grams += found.keys()
                    times += found.values()
                at = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array(grams, pa.string()), pa.array(times, pa.int64()),
                     part.column(2).take(at), part.column(3).take(at)],
                    ["id", "gram", "times", "allow", "block"],
                )

    kinds = "id bigint, gram string, times bigint, allow bigint, block bigint"
    return texts.select("id", "text", "allow", "block").mapInArrow(cut, kinds)


def gram_bits(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, bits): by how many bits the model of allowed urls does better at the gram's last symbol.

    A context's share of new symbols goes to the next shorter context, down to a uniform choice among
    ``SYMBOLS``; the shorter grams and contexts of a gram are its ends.
    """
    classes = ("allow", "block")
    longest = grams.groupBy("gram").agg(*(F.sum(F.col("times") * F.col(c)).alias(c) for c in classes))
    ends = F.transform(F.sequence(F.lit(1), F.length("gram")), lambda size: F.right(F.col("gram"), size))
    counts = longest.select(F.explode(ends).alias("gram"), *classes).groupBy("gram").agg(*(F.sum(c).alias(c) for c in classes))
    counts = counts.withColumn("size", F.length("gram"))
    counts = stored(counts.withColumn("context", F.expr("left(gram, size - 1)")), "counts")
    contexts = counts.groupBy("context").agg(
        *(F.sum(c).alias(f"{c}_total") for c in classes), *(F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in classes)
    )
    known = stored(counts.join(contexts, "context"), "known")

    def chance(of: str, lower: Column) -> Column:
        total, kinds = F.col(f"{of}_total"), F.col(f"{of}_kinds")
        return F.when(total > 0, (F.col(of) + kinds * lower) / (total + kinds)).otherwise(lower)

    uniform = F.lit(1 / SYMBOLS)
    level = known.where("size = 1").select("gram", *(chance(c, uniform).alias(f"{c}_chance") for c in classes))
    levels = None
    for size in range(2, order + 2):
        lower = level.select(F.col("gram").alias("end"), *(F.col(f"{c}_chance").alias(f"{c}_lower") for c in classes))
        own = known.where(F.col("size") == size).withColumn("end", F.right(F.col("gram"), F.lit(size - 1)))
        own = own.join(lower, "end").select("gram", *(chance(c, F.col(f"{c}_lower")).alias(f"{c}_chance") for c in classes))
        level = stored(own, "level")
        levels = level if levels is None else levels.unionByName(level)
    return levels.select("gram", (F.log2("allow_chance") - F.log2("block_chance")).alias("bits"))


def text_ratios(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(text, ratio): bits per symbol by which the allowed model does better, for distinct texts."""
    grams = stored(text_grams(texts, order), "grams")
    own = grams.select("id", "gram", "times").join(gram_bits(grams, order), "gram")
    sums = own.groupBy("id").agg((F.sum(F.col("times") * F.col("bits")) / F.sum("times")).alias("ratio"))
    return texts.select("id", "text").join(sums, "id").select("text", "ratio")


def logistic(
    x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 50, balanced: bool = True
) -> tuple[float, float]:
    """Slope and offset of a logistic curve by damped Newton steps; ``balanced`` weighs both classes alike."""
    weight = np.full(len(y), 1 / len(y))
    if balanced:
        weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    design, beta = np.column_stack([x, np.ones_like(x)]), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (p - y)) + penalty * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + penalty * np.eye(2)
        move = np.linalg.solve(curve, slope)
        beta -= move / max(1.0, np.abs(move).max() / 5)
    return float(beta[0]), float(beta[1])


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and ``chance`` where the method decided.

    Both models are fitted on all judged rows but one fold, the curve on at most ``CALIBRATION_ROWS`` rows
    of that fold. Null urls and urls without ``://`` have empty host and path and fit no rule; the method
    reads the whole url, a null as an empty text. Repeated rows are judged alike. Without training rows in
    both classes the method allows. An empty table gives no rows. Other columns are not read.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), F.coalesce("url", F.lit("")).alias("text"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = parts.select("*", rule.alias("rule"), verdict.alias("verdict"), in_fold("page_id", CALIBRATION_FOLDS, 0).alias("kept_out"))
    counted = [F.count_if(~F.col("kept_out") & F.col("verdict").eqNullSafe(c)).alias(c) for c in ("allow", "block")]
    texts = stored(rows.groupBy("text").agg(*counted).withColumn("id", F.monotonically_increasing_id()), "texts")
    trained = texts.agg(F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0))).first()
    if min(trained) == 0:
        return rows.select(
            "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"),
            F.when(F.col("verdict").isNull(), 0.5).alias("chance"),
        )
    ratios = stored(text_ratios(texts), "ratios")
    sample = rows.where(F.col("kept_out") & F.col("verdict").isNotNull())
    sample = sample.orderBy(F.xxhash64("page_id", "text"), "text").limit(CALIBRATION_ROWS)
    known = sample.join(ratios, "text").select("ratio", F.col("verdict") == "allow").collect()
    slope, offset = 0.0, 0.0
    if known:
        slope, offset = logistic(np.array([r[0] for r in known]), np.array([r[1] for r in known], dtype=float))
    reach = F.greatest(F.least(F.col("ratio") * slope + offset, F.lit(60.0)), F.lit(-60.0))
    open_rows = rows.join(ratios, "text").withColumn("chance", F.when(F.col("verdict").isNull(), 1 / (1 + F.exp(-reach))))
    decided = F.coalesce("verdict", F.when(F.col("chance") < 0.5, "block").otherwise("allow"))
    return open_rows.select("page_id", "host", "path", "rule", decided.alias("verdict"), "chance")


def op1_url_filter(pages: DataFrame) -> DataFrame:
    return judge_urls(pages)

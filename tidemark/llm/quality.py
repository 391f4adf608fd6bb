"""Quality rules with thresholds that follow the data of each language and source.

Five measures per document, in thousandths, go into quantile sketches: histograms whose cells keep
the six leading bits of a value, so a quantile is right to about 3 % whatever its size. Sketches
merge by adding counts: tasks, sources and languages alike. A measure's threshold in a group is its
upper quartile plus a multiple of the distance between the quartiles; groups too small to tell use
their language's merged sketch, or that of the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, stored, text_or_empty

# The base rules.
MIN_WORDS, MAX_REPEATED, WINDOW_WORDS = 20, 30, 8
SYMBOLS = "[^#*$%&|<>]+"

MIN_GROUP = 200
SPREADS = 4
# Per measure: the least distance between quartiles that is believed, in thousandths.
FLOORS = {"symbols": 50, "long_words": 500, "dup_lines": 100, "repeats": 75, "echoes": 50}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row, also where ``use`` runs over an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _covered(places: Column) -> Column:
    """Words within the windows that begin at the given ascending places."""
    steps = F.transform(
        places,
        lambda at, n: F.when(
            n + 1 < F.size(places), F.least(F.lit(WINDOW_WORDS), F.get(places, n + 1) - at)
        ).otherwise(WINDOW_WORDS),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def _repeated_places(hashes: Column) -> Column:
    """Places of the values that occur more than once, found between neighbours in sorted order."""
    ranked = F.sort_array(F.transform(hashes, lambda h, n: F.struct(h.alias("h"), n.alias("n"))))

    def beside(sorted_: Column) -> Column:
        found = F.transform(
            sorted_,
            lambda e, k: F.when(
                ((k > 0) & (F.get(sorted_, k - 1)["h"] == e["h"]))
                | ((k + 1 < F.size(sorted_)) & (F.get(sorted_, k + 1)["h"] == e["h"])),
                e["n"],
            ),
        )
        return F.sort_array(F.filter(found, lambda n: n.isNotNull()))

    return let(ranked, beside)


def n_repeat_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more. Windows are compared by 64-bit hashes."""

    def of(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW_WORDS),
            lambda n: F.xxhash64(*(F.get(hashes, n + k) for k in range(WINDOW_WORDS))),
        )
        return let(
            windows,
            lambda w: F.when(
                F.size(F.array_distinct(w)) < F.size(w), let(_repeated_places(w), _covered)
            ).otherwise(0),
        )

    enough = F.size(words) >= WINDOW_WORDS
    return F.when(enough, let(F.transform(words, lambda w: F.xxhash64(w)), of)).otherwise(0)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts of every whole text, and the verdict of the base rules."""
    text = text_or_empty()
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    counts = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            n_repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda word, n: (n > 0) & (word == F.get(w, n - 1)))).cast("long").alias("n_echoes"),
        ),
    )
    line_counts = let(
        lines,
        lambda held: F.struct(
            F.size(held).cast("long").alias("n_lines"),
            (F.size(held) - F.size(F.array_distinct(held))).cast("long").alias("n_dup_lines"),
        ),
    )
    rows = docs.select(
        "doc_id",
        "lang",
        "source",
        counts.alias("w"),
        line_counts.alias("l"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
    )
    flat = rows.select("doc_id", "lang", "source", "w.*", "l.*", "n_symbols")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return flat.withColumn("base_failed", failed)


def _thousandths(part: str, whole: str) -> Column:
    return F.expr(f"CASE WHEN {whole} > 0 THEN 1000 * {part} DIV {whole} ELSE 0 END")


def scaled() -> dict[str, Column]:
    return {
        "symbols": _thousandths("n_symbols", "n_words"),
        "long_words": _thousandths("word_chars", "n_words"),
        "dup_lines": _thousandths("n_dup_lines", "n_lines"),
        "repeats": _thousandths("n_repeat_words", "n_words"),
        "echoes": _thousandths("n_echoes", "n_words"),
    }


def cell(value: Column) -> Column:
    """A value with all but its six leading bits cleared."""
    low = F.greatest(F.lit(0), F.length(F.bin(value)) - 6)
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, measure, cell, n: one mergeable sketch per language, source and measure."""
    pairs = [F.struct(F.lit(name).alias("measure"), cell(value).alias("cell")) for name, value in scaled().items()]
    each = rows.select("lang", "source", F.inline(F.array(*pairs)))
    return each.groupBy("lang", "source", "measure", "cell").agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame, keys: list[str], spreads: int = SPREADS) -> DataFrame:
    """Per group of ``keys``, its number of rows and the largest value each measure may take."""
    merged = sketch.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    up_to = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.select(*keys, "measure", "cell", F.sum("n").over(up_to).alias("upto"), F.sum("n").over(group).alias("rows"))
    quartiles = ranked.groupBy(*keys, "measure").agg(
        F.max("rows").alias("rows"),
        F.min(F.when(4 * F.col("upto") >= F.col("rows"), F.col("cell"))).alias("low"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("rows"), F.col("cell"))).alias("high"),
    )
    floor = F.create_map(*(F.lit(x) for pair in FLOORS.items() for x in pair))[F.col("measure")]
    most = F.col("high") + spreads * F.greatest(F.col("high") - F.col("low"), floor)
    limits = [F.max(F.when(F.col("measure") == name, F.col("most"))).alias(f"max_{name}") for name in FLOORS]
    return quartiles.withColumn("most", most).groupBy(*keys).agg(F.max("rows").alias("rows"), *limits)


def adaptive_limits(sketch: DataFrame, min_group: int = MIN_GROUP, spreads: int = SPREADS) -> DataFrame:
    """The limits that hold for each language and source that occurs."""
    names = [f"max_{name}" for name in FLOORS]

    def level(keys: list[str]) -> DataFrame:
        return thresholds(sketch, keys, spreads).select(*(F.col(k).alias(f"_{k}") for k in keys), F.struct("rows", *names).alias("own"))

    groups = thresholds(sketch, ["lang", "source"], spreads)
    by_lang, overall = level(["lang"]), level([])
    wide = groups.join(by_lang.withColumnRenamed("own", "by_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    wide = wide.join(F.broadcast(overall.withColumnRenamed("own", "overall")), F.lit(True), "left")
    use = [
        F.when(F.col("rows") >= min_group, F.col(name))
        .when(F.col("by_lang.rows") >= min_group, F.col(f"by_lang.{name}"))
        .otherwise(F.col(f"overall.{name}"))
        .alias(name)
        for name in names
    ]
    return wide.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *use)


def judge(docs: DataFrame, min_group: int = MIN_GROUP, spreads: int = SPREADS) -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base rules; failed rows are in no sketch. Null is
    a language and a source of its own. Repeated rows are judged alike. An empty table gives no rows.
    """
    rows = stored(measures(docs), "measures")
    limits = adaptive_limits(sketches(rows.where("NOT base_failed")), min_group, spreads)
    joined = rows.join(
        limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    within = F.lit(True)
    for name, value in scaled().items():
        within = within & (value <= F.col(f"max_{name}"))
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(True))).drop("_lang", "_source")


def op5_quality(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS pos FROM d WHERE len(words) >= 8
), twice AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, words[pos:pos + 7]) AS n FROM starts) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n_repeat_words FROM twice, range(8) AS r(k) GROUP BY doc_id
), echoes AS (
  SELECT doc_id, count(*) AS n_echoes FROM (SELECT doc_id, words, unnest(range(2, len(words) + 1)) AS pos FROM d)
  WHERE words[pos] = words[pos - 1] GROUP BY doc_id
), m AS (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_echoes, 0) AS n_echoes
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN echoes USING (doc_id)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbols,
         CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END AS long_words,
         CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
         CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats,
         CASE WHEN n_words > 0 THEN 1000 * n_echoes // n_words ELSE 0 END AS echoes
  FROM m
), v AS (
  SELECT lang, source, measure, v, greatest(0, length(bin(v)) - 6) AS low FROM (
    SELECT lang, source, unnest(['symbols', 'long_words', 'dup_lines', 'repeats', 'echoes']) AS measure,
           unnest([symbols, long_words, dup_lines, repeats, echoes]) AS v FROM b WHERE NOT base_failed)
), h AS (
  SELECT lang, source, measure, (v >> low) << low AS cell, count(*) AS n FROM v GROUP BY ALL
), q AS (
  SELECT level, lang, source, measure, max(total) AS total,
         min(cell) FILTER (4 * upto >= total) AS low, min(cell) FILTER (4 * upto >= 3 * total) AS high
  FROM (
    SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY cell) AS upto,
           sum(n) OVER (PARTITION BY level, lang, source, measure) AS total
    FROM (
      SELECT 2 AS level, lang, source, measure, cell, n FROM h
      UNION ALL SELECT 1, lang, NULL, measure, cell, sum(n) FROM h GROUP BY ALL
      UNION ALL SELECT 0, NULL, NULL, measure, cell, sum(n) FROM h GROUP BY ALL))
  GROUP BY ALL
), t AS (
  SELECT level, lang, source, measure, total,
         high + 4 * greatest(high - low, CASE measure WHEN 'long_words' THEN 500 WHEN 'dup_lines' THEN 100 WHEN 'repeats' THEN 75 ELSE 50 END) AS most FROM q
), j AS (
  SELECT doc_id, measure, value <= coalesce(
           (SELECT most FROM t WHERE level = 2 AND total >= 200 AND t.measure = x.measure
              AND t.lang IS NOT DISTINCT FROM x.lang AND t.source IS NOT DISTINCT FROM x.source),
           (SELECT most FROM t WHERE level = 1 AND total >= 200 AND t.measure = x.measure
              AND t.lang IS NOT DISTINCT FROM x.lang),
           (SELECT most FROM t WHERE level = 0 AND t.measure = x.measure), 1 << 60) AS fits
  FROM (SELECT doc_id, lang, source, unnest(['symbols', 'long_words', 'dup_lines', 'repeats', 'echoes']) AS measure,
               unnest([symbols, long_words, dup_lines, repeats, echoes]) AS value FROM b) AS x
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND fits AS kept
FROM b JOIN (SELECT doc_id, bool_and(fits) AS fits FROM j GROUP BY doc_id) USING (doc_id)
"""

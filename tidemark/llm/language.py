"""Language identification by prediction by partial matching over bytes.

Every language has a tree of byte contexts of up to ``ORDER`` bytes. A byte costs what its longest
known context gives it; a context that has not seen it is charged its escape and hands over to the
next shorter one, down to a uniform choice of a byte. Statistics are frozen, so the code length of a
text is exact and adds up over its words: contexts end at the white space before a word. A word's
code lengths are therefore worked out once per worker, and a text is the sum of its words.

All grams of all training rows count. Trees that are too large to broadcast together are sent in parts,
of some languages each, and a language that is too large alone in parts by the byte before the coded
one: all contexts of a position end in that byte, so each part gives the code lengths of its positions
and a text's are the sum over parts.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_fold, slices, stored

ORDER = 3
HELD_OUT = (4, 2)
# Bounds of a part that is broadcast (grams times languages) and of what a worker remembers.
PART_CELLS = 8_000_000
MEMO_CELLS = 4_000_000
GRAMS = "lang string, size int, code bigint, n bigint"
UND = "und"
_letter = re.compile(r"[^\W\d_]").search


def positions(words: list[bytes], order: int = ORDER) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """For words laid out with a space before, between and after: the word of every coded byte (its
    bytes and the space that ends it), its grams of 1 to order + 1 bytes as numbers, and how many bytes
    of context it has."""
    laid = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.int64)
    place = np.arange(len(laid))
    begins = np.maximum.accumulate(np.where(laid == 32, place, 0))
    context = place[1:] - begins[:-1]
    word = np.cumsum(laid == 32)[:-1] - 1
    codes = [laid[1:]]
    for size in range(1, order + 1):
        longer = codes[-1].copy()
        longer[size - 1 :] |= laid[: len(laid) - size] << (8 * size)
        codes.append(longer)
    return word, codes, context


def count_grams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, size, code, n over all rows (``lang``, ``text``), counted in each task and then summed."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return codes, np.bincount(back, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = defaultdict(list)
        for batch in batches:
            for part in slices(batch, "text"):
                words: dict[str, Counter] = defaultdict(Counter)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words[lang].update(text.encode().split())
                for lang, counts in words.items():
                    if not counts:
                        continue
                    word, codes, context = positions(list(counts), order)
                    weight = np.fromiter(counts.values(), dtype=np.int64)[word]
                    for size, code in enumerate(codes, 1):
                        held, enough = found[lang, size], context >= size - 1
                        held.append(merged([(code[enough], weight[enough])]))
                        if len(held) > 8:
                            found[lang, size] = [merged(held)]
        for (lang, size), parts in found.items():
            codes, n = merged(parts)
            for at in range(0, len(codes), 50_000):
                c, m = codes[at : at + 50_000], n[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c), pa.string()), pa.array(np.full(len(c), size, np.int32)),
                     pa.array(c), pa.array(m)],
                    ["lang", "size", "code", "n"],
                )

    parts = rows.select("lang", "text").mapInArrow(count, GRAMS)
    return parts.groupBy("lang", "size", "code").agg(F.sum("n").alias("n"))


class ContextTrees:
    """Frozen trees of some languages, by gram size: sorted gram numbers with a cost in bits per language
    (infinite where unseen), and sorted context numbers with the cost of their escape (0 where unseen).
    Of positions, those count whose last context byte is one of ``ends``."""

    def __init__(
        self, langs: list[str], grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], order: int = ORDER,
        ends: range = range(256),
    ):
        """``grams``: per size, the language number, code and count of every gram."""
        self.langs, self.order, self.ends = langs, order, ends
        self.costs, self.escapes = {}, {}
        for size, (lang, code, n) in grams.items():
            codes, row = np.unique(code, return_inverse=True)
            contexts, above = np.unique(code >> 8, return_inverse=True)
            cells = above * len(langs) + lang
            total = np.bincount(cells, n, len(contexts) * len(langs))
            kinds = np.bincount(cells, minlength=len(contexts) * len(langs))
            cost = np.full((len(codes), len(langs)), np.inf, dtype=np.float32)
            cost[row, lang] = np.log2(total[cells] + kinds[cells]) - np.log2(n)
            escape = np.zeros(len(contexts) * len(langs))
            seen = kinds > 0
            escape[seen] = np.log2(total[seen] + kinds[seen]) - np.log2(kinds[seen])
            self.costs[size] = codes, cost
            self.escapes[size] = contexts, escape.reshape(-1, len(langs)).astype(np.float32)

    def word_bits(self, words: list[bytes]) -> np.ndarray:
        """Code length of every word in every language."""
        word, codes, context = positions(words, self.order)
        bits = np.zeros((len(word), len(self.langs)), dtype=np.float32)
        todo = np.ones(bits.shape, dtype=bool)
        if len(self.ends) < 256:
            last = codes[1] >> 8
            todo &= ((last >= self.ends.start) & (last < self.ends.stop))[:, None]
        for size in range(self.order + 1, 0, -1):
            if size not in self.costs:
                continue
            reach = np.flatnonzero(context >= size - 1)
            code = codes[size - 1][reach]
            known, cost = self.costs[size]
            at = np.minimum(np.searchsorted(known, code), len(known) - 1)
            hit = known[at] == code
            own = np.where(hit[:, None], cost[at], np.inf)
            now = todo[reach]
            seen = now & np.isfinite(own)
            contexts, escape = self.escapes[size]
            at = np.minimum(np.searchsorted(contexts, code >> 8), len(contexts) - 1)
            out = np.where((contexts[at] == code >> 8)[:, None], escape[at], 0)
            bits[reach] += np.where(seen, own, np.where(now, out, 0))
            todo[reach] = now & ~seen
        bits[todo] += 8
        return np.add.reduceat(bits, np.flatnonzero(np.diff(word, prepend=-1)), axis=0)


class Identifier:
    """Scores texts; remembers the words it has seen, within a bound."""

    def __init__(self, trees: ContextTrees):
        self.trees, self.memo = trees, {}
        self.limit = max(1000, MEMO_CELLS // max(1, len(trees.langs)))
        self.table = np.zeros((0, len(trees.langs)), dtype=np.float32)
        self.filled = 0

    def _learn(self, words: set[bytes]) -> None:
        if len(self.memo) > self.limit:
            keep = [word for word in words if word in self.memo]
            rows = self.table[[self.memo[word] for word in keep]]
            self.memo = {word: n for n, word in enumerate(keep)}
            self.table, self.filled = rows, len(keep)
        new = [word for word in words if word not in self.memo]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            rows = self.trees.word_bits(part)
            if self.filled + len(part) > len(self.table):
                room = np.zeros((len(self.table) // 2 + len(part), self.table.shape[1]), dtype=np.float32)
                self.table = np.concatenate([self.table[: self.filled], room])
            self.table[self.filled : self.filled + len(part)] = rows
            self.memo.update(zip(part, range(self.filled, self.filled + len(part))))
            self.filled += len(part)

    def bits(self, texts: list[str | None]) -> tuple[list[bool], np.ndarray]:
        """Which texts can be judged, and the code length of every text in every language."""
        judged = [text is not None and _letter(text) is not None for text in texts]
        split = [text.encode().split() if good else [] for text, good in zip(texts, judged)]
        self._learn(set().union(*split))
        made = np.zeros((len(texts), len(self.trees.langs)))
        for n, words in enumerate(split):
            if words:
                rows = np.fromiter(map(self.memo.__getitem__, words), dtype=np.int64, count=len(words))
                made[n] = self.table[rows].sum(axis=0, dtype=np.float64)
        return judged, made

    def identify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.trees.langs:
            return [UND] * len(texts), [0.0] * len(texts)
        judged, bits = self.bits(texts)
        best = bits.argmin(axis=1)
        gap = np.maximum(bits[np.arange(len(texts)), best][:, None] - bits, -1000)
        scores = 1 / np.exp2(gap).sum(axis=1)
        langs = [self.trees.langs[k] if good else UND for good, k in zip(judged, best)]
        return langs, [float(score) if good else 0.0 for good, score in zip(judged, scores)]


class Part(NamedTuple):
    """Languages, and the last context bytes of the positions that the part is for."""

    langs: list[str]
    ends: range


class Model(NamedTuple):
    """All grams (``lang``, ``size``, ``code``, ``n``) as a written table, and its parts."""

    grams: DataFrame
    parts: list[Part]
    order: int

    def trees(self, part: Part) -> ContextTrees:
        own = self.grams.where(F.col("lang").isin(part.langs))
        if len(part.ends) < 256:
            own = own.where((F.col("size") == 1) | _end().between(part.ends.start, part.ends.stop - 1))
        place = {lang: n for n, lang in enumerate(part.langs)}
        rows, grams = own.select("lang", "size", "code", "n").toPandas(), {}
        for size, held in rows.groupby("size"):
            grams[int(size)] = held["lang"].map(place).to_numpy(), held["code"].to_numpy(), held["n"].to_numpy()
        return ContextTrees(part.langs, grams, self.order, part.ends)


def _end() -> Column:
    """The last byte of a gram's context; none for grams of one byte."""
    return F.when(F.col("size") > 1, F.shiftright("code", 8).bitwiseAND(255))


def cut_parts(sizes: dict[str, dict[int | None, int]], cells: int = PART_CELLS) -> list[Part]:
    """Parts of at most ``cells`` grams times languages, from each language's number of grams by last
    context byte (None for grams without context, which every part has). One byte of one language is not
    cut further: at order 3 it has at most 256^3 + 256^2 + 256 grams."""
    parts, group, held = [], [], 0
    for lang in sorted(sizes):
        own = sum(sizes[lang].values())
        if group and (own > cells or (held + own) * (len(group) + 1) > cells):
            parts.append(Part(group, range(256)))
            group, held = [], 0
        if own <= cells:
            group, held = [*group, lang], held + own
            continue
        start, filled = 0, 0
        for byte in range(256):
            more = sizes[lang].get(byte, 0)
            if filled and filled + more > cells:
                parts.append(Part([lang], range(start, byte)))
                start, filled = byte, 0
            filled += more
        parts.append(Part([lang], range(start, 256)))
    return [*parts, Part(group, range(256))] if group else parts


def train(rows: DataFrame, order: int = ORDER, cells: int = PART_CELLS) -> Model:
    """Trees from all given rows (``lang``, ``text``, neither null); every gram counts."""
    counted = stored(count_grams(rows, order), "grams")
    sizes: dict[str, dict] = defaultdict(dict)
    for lang, end, n in counted.groupBy("lang", _end().alias("end")).count().collect():
        sizes[lang][end] = n
    return Model(counted, cut_parts(sizes, cells), order)


def _scored(rows: DataFrame, trees: ContextTrees) -> DataFrame:
    """All columns but the text, with lang_pred and score."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                langs, scores = identifier.identify(part.column(part.schema.get_field_index("text")).to_pylist())
                held = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*held.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    [*held.schema.names, "lang_pred", "score"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(score, f"{kinds}, lang_pred string, score double")


def _part_bits(rows: DataFrame, trees: ContextTrees) -> DataFrame:
    """(row, lang, bits) of every text that can be judged, over the part's positions."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                judged, bits = identifier.bits(part.column(1).to_pylist())
                good = np.flatnonzero(judged)
                langs = identifier.trees.langs
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(good, len(langs)))), pa.array(langs * len(good), pa.string()),
                     pa.array(bits[good].ravel())],
                    ["row", "lang", "bits"],
                )

    return rows.select("row", "text").mapInArrow(measure, "row bigint, lang string, bits double")


def identify(docs: DataFrame, model: Model, **columns) -> DataFrame:
    """doc_id, the given further columns, lang_pred and score of every whole text."""
    rows = docs.select("doc_id", *(c.alias(n) for n, c in columns.items()), "text")
    if len(model.parts) < 2:
        return _scored(rows, model.trees(model.parts[0]) if model.parts else ContextTrees([], {}))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    bits = None
    for part in model.parts:
        made = stored(_part_bits(rows, model.trees(part)), "bits")
        bits = made if bits is None else bits.unionByName(made)
    whole = bits.groupBy("row", "lang").agg(F.sum("bits").alias("bits"))
    best = whole.groupBy("row").agg(F.min(F.struct("bits", "lang")).alias("best"), F.collect_list("bits").alias("all"))
    gap = F.transform("all", lambda b: F.pow(F.lit(2.0), F.greatest(F.col("best.bits") - b, F.lit(-1000.0))))
    best = best.select("row", F.col("best.lang").alias("lang_pred"), (1 / F.aggregate(gap, F.lit(0.0), lambda a, b: a + b)).alias("score"))
    found = rows.drop("text").join(best, "row", "left").drop("row")
    return found.withColumns({"lang_pred": F.coalesce("lang_pred", F.lit(UND)), "score": F.coalesce("score", F.lit(0.0))})


def op9_language(docs: DataFrame) -> DataFrame:
    """Learns from the rows outside the held-out fold and predicts all rows.

    Null texts and texts without a letter are ``und`` with score 0, as is every text when there is no
    training row. Ties go to the language that sorts first. Repeated rows are scored alike.
    """
    held_out = in_fold("doc_id", *HELD_OUT)
    model = train(docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    return identify(docs, model, held_out=held_out)

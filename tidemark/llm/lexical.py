"""Ranked lexical search: item vocabulary tiles times document impact tiles, multiplied by BLAS.

A document's impact of a term and a term's weight are integers, so an item's score of a document is an
integer sum of products: an entry of (items x terms) @ (terms x documents). The documents are read once
for their counts of the items' terms. A task then takes its documents in tiles, lays the impacts out as a
dense matrix over just those terms of an item tile that the documents have, and multiplies in float64.
The terms of a product are cut where partial sums could reach 2^53, so every partial sum is exact; the
parts are added as 64-bit integers. Each tile hands its best documents to the task's own best, by score
and doc_id, and Spark ranks what the tasks have left.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored

TOP = 20
ITEM_BYTES = 128 << 10
ITEMS_PER_TILE = 256
DOCS_PER_TILE = 256
TERMS_PER_TILE = 1024
LENGTH_SHARE = 25
IMPACT_UNIT = 1_000_000_000
# Impacts are below 10^6, so a product over weights that add up to no more than this is exact.
EXACT_WEIGHT = (1 << 53) // 1_000_000 // 2
# ASCII letters and digits, lower-cased, and all other code points are parts of terms.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())
POSTINGS = "doc_id bigint, n bigint, terms array<int>, times array<int>"
FOUND = "item bigint, doc_id bigint, score bigint"


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TERM_BYTES).split()


class ItemTile(NamedTuple):
    """Items with the vocabulary that they use: ``layers`` of weights, items x terms, which add up to the
    items' weights and hold no weight beyond ``EXACT_WEIGHT``."""

    items: np.ndarray
    column: np.ndarray
    layers: list[np.ndarray]


def item_tiles(items: list[tuple[int, list[int]]], weights: np.ndarray) -> Iterator[ItemTile]:
    """Tiles of items given as (number, places of their terms in the vocabulary)."""
    for at in range(0, len(items), ITEMS_PER_TILE):
        part = items[at : at + ITEMS_PER_TILE]
        own = sorted({term for _, terms in part for term in terms})
        column = np.full(len(weights), -1, dtype=np.int64)
        column[own] = np.arange(len(own))
        whole = np.zeros((len(part), len(own)), dtype=np.int64)
        for row, (_, terms) in enumerate(part):
            for term, times in Counter(terms).items():
                whole[row, column[term]] = times * weights[term]
        layers = []
        while whole.any():
            layers.append(np.minimum(whole, EXACT_WEIGHT))
            whole -= layers[-1]
        yield ItemTile(np.array([number for number, _ in part]), column, [a.astype(np.float64) for a in layers])


def exact_cuts(layer: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of terms whose weights add up to at most ``EXACT_WEIGHT`` for every item."""
    start, held = 0, 0.0
    for at, most in enumerate(layer.max(axis=0, initial=0.0)):
        if at > start and (held + most > EXACT_WEIGHT or at - start == TERMS_PER_TILE):
            yield start, at
            start, held = at, 0.0
        held += most
    if start < layer.shape[1]:
        yield start, layer.shape[1]


def tile_scores(tile: ItemTile, terms: np.ndarray, place: np.ndarray, impacts: np.ndarray, width: int) -> np.ndarray:
    """Scores, items x documents, from the documents' entries (term, place of the document, impact)."""
    columns = tile.column[terms]
    held = columns >= 0
    present, row = np.unique(columns[held], return_inverse=True)
    dense = np.zeros((len(present), width))
    dense[row, place[held]] = impacts[held]
    scores = np.zeros((len(tile.items), width), dtype=np.int64)
    for layer in tile.layers:
        compact = layer[:, present]
        for a, b in exact_cuts(compact):
            scores += np.rint(compact[:, a:b] @ dense[a:b]).astype(np.int64)
    return scores


class Best:
    """The best documents so far of a tile's items: larger scores first, then smaller ids, null ids last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.scores = np.zeros((items, top), dtype=np.int64)
        self.ids = np.zeros((items, top), dtype=np.int64)
        self.null = np.zeros((items, top), dtype=bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        # A document as good as the last one kept may come before it by its id.
        rows = np.flatnonzero(scores.max(axis=1) >= np.maximum(self.scores[:, -1], 1))
        if not len(rows):
            return
        every = len(rows), scores.shape[1]
        scores = np.hstack([self.scores[rows], scores[rows]])
        ids = np.hstack([self.ids[rows], np.broadcast_to(ids, every)])
        null = np.hstack([self.null[rows], np.broadcast_to(null, every)])
        order = np.lexsort((ids, null, -scores), axis=1)[:, : self.top]
        for kept, values in ((self.scores, scores), (self.ids, ids), (self.null, null)):
            kept[rows] = np.take_along_axis(values, order, axis=1)


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Each document that has a term: the number of its terms, and which of the vocabulary it has how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: n + 1 for term, n in vocabulary.items()}.get
        for batch in batches:
            for part in slices(batch, "text"):
                ids, sizes, terms, times, ends = [], [], [], [], [0]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    own = terms_of(text)
                    if not own:
                        continue
                    found = Counter(filter(None, map(place, own)))
                    ids.append(doc_id)
                    sizes.append(len(own))
                    terms += found.keys()
                    times += found.values()
                    ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array([t - 1 for t in terms], pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                    ["doc_id", "n", "terms", "times"],
                )

    return docs.select("doc_id", "text").mapInArrow(count, POSTINGS)


def _ranked(postings: DataFrame, tiles, total_docs: int, total_terms: int, top: int) -> DataFrame:
    """Each task's best documents of every item."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(len(tile.items), top) for tile in tiles.value]
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_PER_TILE):
                part = batch.slice(at, DOCS_PER_TILE)
                ids, n, terms, times = part.columns
                place = np.repeat(np.arange(part.num_rows), np.diff(terms.offsets.to_numpy()))
                tf = times.flatten().to_numpy().astype(np.int64)
                sizes = n.to_pylist()
                length = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * s * total_docs // total_terms for s in sizes])
                impacts = IMPACT_UNIT * tf // (1000 * tf + 12 * length[place])
                number, null = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
                where = terms.flatten().to_numpy()
                for tile, held in zip(tiles.value, best):
                    held.add(tile_scores(tile, where, place, impacts, part.num_rows), number, null)
        for tile, held in zip(tiles.value, best):
            row, k = np.nonzero(held.scores)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tile.items[row]), pa.array(held.ids[row, k], mask=held.null[row, k]), pa.array(held.scores[row, k])],
                ["item", "doc_id", "score"],
            )

    return postings.mapInArrow(rank, FOUND)


def _best(found: DataFrame, top: int, *keys: str) -> DataFrame:
    order = Window.partitionBy("item", *keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of each row of ``items``: item_id, rank, doc_id, score.

    Null and empty texts hold no term: such documents are never found and count for nothing, such items
    find nothing. Repeated rows are documents, or items, of their own; of equal scores the smaller doc_id
    comes first, null ids last. Empty tables give no rows. Other columns are not read.

    Items are worked off in groups of about ``ITEM_BYTES`` of text; a group's vocabulary and weights are
    all that tasks are sent. Each group reads the documents anew.
    """
    spark = docs.sparkSession
    asked = items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.encode("text", "utf-8").alias("text"))
    asked = stored(asked, "items")
    found, group, held = None, [], 0

    def work_off() -> None:
        nonlocal found, group, held
        if group:
            part = stored(_search_group(docs, group, top), "found")
            found = part if found is None else found.unionByName(part)
        group, held = [], 0

    for row in asked.toLocalIterator():
        terms = terms_of(row.text)
        if terms:
            group.append((row.item, terms))
            held += len(row.text)
        if held > ITEM_BYTES:
            work_off()
    work_off()
    if found is None:
        found = spark.createDataFrame([], FOUND + ", rank int")
    return found.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _search_group(docs: DataFrame, group: list[tuple[int, list[bytes]]], top: int) -> DataFrame:
    vocabulary = {term: n for n, term in enumerate(dict.fromkeys(term for _, terms in group for term in terms))}
    postings = stored(_postings(docs, vocabulary), "postings")
    total_docs, total_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for term, held in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = held
    weights = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * n + 1))) for n in df.tolist()])
    places = [(item, [vocabulary[term] for term in terms]) for item, terms in group]
    tiles = docs.sparkSession.sparkContext.broadcast(list(item_tiles(places, weights)))
    task = F.spark_partition_id() % 64
    few = _best(_ranked(postings, tiles, total_docs, total_terms, top).withColumn("task", task), top, "task")
    return _best(few.drop("rank", "task"), top)


def op11_lexical_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), q AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark
), s AS (
  SELECT count(*)::BIGINT AS big_n, sum(len(t))::BIGINT AS big_l FROM d WHERE len(t) > 0
), p AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d) GROUP BY ALL
), f AS (
  SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term
), w AS (
  SELECT i, item_id, term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT i, item_id, unnest(t) AS term FROM q) JOIN f USING (term) CROSS JOIN s
), z AS (
  SELECT i, item_id, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM w JOIN p USING (term) CROSS JOIN s GROUP BY ALL
), k AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM z WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""

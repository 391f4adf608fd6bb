"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact intersection.

A text's set is that of its distinct word n-grams, as sorted 64-bit hashes. Sets are banded by size;
a pair is looked for in the band of its larger set, so a set enters its own band and, if it is large
enough to have a partner there, the next one. In a band two linked sets differ in at most k elements
(k follows from the band's largest size), so cutting the range of hashes into more than k parts leaves
a part in which they agree. Sets that agree in a part of a band meet in a tile; nothing that links can
miss its tile, and texts which share just a passage seldom agree in a whole part.

Within a tile a bitmap per set (bit h mod m for each element) bounds the overlap from above: every
bit that only one set has is an element that the other lacks. What passes is decided by intersecting
the sorted arrays, which are made for sets of such pairs only. Each set is first held against the
smallest of the tile-mates that it meets most, if the bitmaps allow the two to link;
tiles whose members are then all connected are done. In the others each set is held against the one
tile-mate of another component that its bitmap puts closest, and components are joined, as long as
that finds links; a large group of near copies so comes down to one pair per member and round. What
then remains apart is worked off block by block, whatever its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import forget, remove, slices, stored, text_or_empty
from tidemark.llm.components import components
from tidemark.session import work_path

WORDS_PER_SHINGLE = 3
THRESHOLD = (9, 10)
BAND_RATIO = 1.5
BLOCK = 1024
KEY_PARTS = 2
FILTER_BITS = 1 << 24
# Odd multipliers of the mixing steps.
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SETS = "row bigint, doc_id bigint, text_key string, n bigint, digest binary, bits binary, keys array<bigint>"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts. Each distinct word of the texts given is hashed once, and
    nothing is kept from call to call."""

    def __init__(self, size: int = WORDS_PER_SHINGLE):
        self.size = size

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        if not texts:
            return []
        split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array([text or "" for text in texts], pa.string())))
        words = split.flatten().dictionary_encode()
        names = words.dictionary.to_numpy(zero_copy_only=False)
        known = np.fromiter(map(xxhash.xxh3_64_intdigest, names), dtype=np.uint64, count=len(names))
        # White space at an end of a text, or no text, gives an empty word.
        place, real = words.indices.to_numpy(), names != ""
        full = real[place]
        ends = np.concatenate([[0], np.cumsum(full)])[np.cumsum(split.value_lengths().to_numpy())].tolist()
        hashes = known[place[full]]
        return [self._set(hashes[begin:end]) for begin, end in zip([0, *ends], ends)]

    def _set(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return hashes
        length = min(self.size, len(hashes))
        total = np.full(len(hashes) - length + 1, length, dtype=np.uint64)
        for k in range(length):
            total = (total ^ hashes[k : len(hashes) - length + 1 + k]) * M1
            total ^= total >> np.uint64(29)
        return np.unique(mixed(total))


def digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


class Bands:
    """Size bands and what a band's tiles need, for sets that link at ``above / below`` and more."""

    def __init__(self, threshold: tuple[int, int] = THRESHOLD, ratio: float = BAND_RATIO):
        self.above, self.below = threshold
        if self.below > self.above * ratio:
            raise ValueError("linked sets must lie in the same band or in neighbouring ones")
        self.begins = [1]
        while self.begins[-1] < 1 << 40:
            self.begins.append(max(self.begins[-1] + 1, int(self.begins[-1] * ratio)))
        self.cuts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.of_band: dict[int, tuple[int, int]] = {}

    def cut(self, band: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a band's parts end in the range of hashes, and a tag for each part."""
        if band not in self.cuts:
            edges = (np.arange(1, parts, dtype=object) * (1 << 64) // parts).astype(np.uint64)
            self.cuts[band] = edges, mixed((np.uint64(band << 32) + np.arange(parts, dtype=np.uint64)) * M1)
        return self.cuts[band]

    def band(self, n: int) -> int:
        return int(np.searchsorted(self.begins, n, side="right")) - 1

    def parts(self, band: int) -> tuple[int, int]:
        """Number of parts, and how many of them agree at least between two linked sets.

        With overlap I and D differing elements, I / (I + D) >= a / b gives I >= D a / (b - a), so the
        sizes' sum 2 I + D is at least D (a + b) / (b - a). The more parts must agree, the fewer sets have
        as many empty ones and so the band's common tile: ``agree`` grows until the band's smallest set,
        spread at random, is expected to have fewer by a standard deviation.
        """
        if band not in self.of_band:
            largest, smallest = self.begins[band + 1] - 1, max(1, self.above * self.begins[band] // self.below)
            differ = 2 * largest * (self.below - self.above) // (self.above + self.below)
            agree = 1
            for share in (16, 8, 4, 2, 1):
                agree = 1 + (1 + differ // share if differ else 0)
                parts = differ + agree
                empty = parts * math.exp(-smallest / parts)
                if empty + math.sqrt(empty) < agree:
                    break
            self.of_band[band] = differ + agree, agree
        return self.of_band[band]

    def bands_of(self, n: int) -> list[int]:
        own = self.band(n)
        return [own, own + 1] if self.below * n >= self.above * self.begins[own + 1] else [own]

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Tile keys of a set: one per part that is not empty. A set with so many empty parts that it
        may agree with a partner in empty ones only also gets the band's key for those."""
        found, weights = [], np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes ^ M1), dtype=np.uint64)])
        for band in self.bands_of(len(hashes)):
            parts, agree = self.parts(band)
            edges, tags = self.cut(band, parts)
            ends = np.concatenate([np.searchsorted(hashes, edges), [len(hashes)]])
            begins = np.concatenate([[0], ends[:-1]])
            full = ends > begins
            found.append(mixed((weights[ends] - weights[begins]) ^ tags)[full])
            if parts - int(full.sum()) >= agree:
                found.append(mixed(np.array([band], dtype=np.uint64) * M3))
        return np.concatenate(found).view(np.int64)

    def bitmap(self, hashes: np.ndarray) -> bytes:
        size = max(64, 1 << int(2 * (self.begins[self.band(len(hashes)) + 1]) - 1).bit_length())
        bits = np.zeros(size, dtype=np.uint8)
        bits[(hashes & np.uint64(size - 1)).astype(np.int64)] = 1
        return np.packbits(bits).tobytes()


BANDS = Bands()


def folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """A bitmap (bytes) folded to ``size`` bytes; bits that meet are joined."""
    return np.bitwise_or.reduce(bitmap.reshape(-1, size), axis=0) if len(bitmap) > size else bitmap


def most_common(n_a: int, a: np.ndarray, n_b: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The largest overlap with a that the bitmaps allow the sets b (sizes, and bitmaps as rows of the
    width of ``a``)."""
    only_a = np.bitwise_count(a[None, :] & ~b).sum(axis=1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a[None, :]).sum(axis=1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def reaches(common, n_a, n_b, bands: Bands = BANDS):
    """Whether sets of these sizes link with so many elements in common; numbers or arrays."""
    return bands.below * common >= bands.above * (n_a + n_b - common)


def links(a: np.ndarray, b: np.ndarray, bands: Bands = BANDS) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return bool(reaches(common, len(a), len(b), bands))


def shingle_sets(docs: DataFrame, bands: Bands = BANDS, words: int = WORDS_PER_SHINGLE) -> DataFrame:
    """One row per document. Bitmap and keys are given once per task for equal sets."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shingler, seen = Shingler(words), set()
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingler.sets(part.column(3).to_pylist())
                names = [digest(s) for s in sets]
                bits, keys, ends = [], [], [0]
                for own, name in zip(sets, names):
                    new = len(own) > 0 and name not in seen
                    seen.add(name)
                    bits.append(bands.bitmap(own) if new else None)
                    keys.append(bands.keys(own) if new else np.zeros(0, dtype=np.int64))
                    ends.append(ends[-1] + len(keys[-1]))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(names, pa.binary()), pa.array(bits, pa.binary()), lists],
                    ["row", "doc_id", "text_key", "n", "digest", "bits", "keys"],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_key().alias("text_key"), "text")
    return rows.mapInArrow(make, SETS)


def text_key() -> Column:
    """What stands for the whole text, null and empty alike, where rows are found again."""
    return F.sha2(text_or_empty(), 256)


def arrays_of(docs: DataFrame, wanted: DataFrame, words: int = WORDS_PER_SHINGLE) -> DataFrame:
    """(node, n, hashes) of the wanted sets (``node``, ``doc_id``, ``digest``), from their texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shingler = Shingler(words)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingler.sets(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["digest", "hashes"],
                )

    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    # A bitset of the wanted ids, as at most FILTER_BITS / 64 rows, keeps most other texts unmoved.
    rows = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("place"))
    marks = ids.select(F.pmod(F.xxhash64("wanted_id"), F.lit(FILTER_BITS)).alias("place"))
    cells = marks.groupBy(F.expr("place DIV 64").alias("cell")).agg(F.expr("bit_or(shiftleft(1L, int(place % 64)))").alias("set"))
    near = rows.join(F.broadcast(cells), F.expr("place DIV 64") == F.col("cell"))
    near = near.where("shiftright(set, int(place % 64)) & 1L = 1").select("text")
    made = near.mapInArrow(make, "digest binary, hashes binary")
    return wanted.select("node", "digest").join(made, "digest").groupBy("node").agg(F.first("hashes").alias("hashes"))


def verified(pairs: DataFrame, arrays: DataFrame, bands: Bands = BANDS) -> DataFrame:
    """The pairs (u, v) whose sets link, by intersection of their sorted arrays."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            sets = [[np.frombuffer(x.as_py(), dtype=np.uint64) for x in batch.column(k)] for k in (2, 3)]
            good = pa.array([links(a, b, bands) for a, b in zip(*sets)], pa.bool_())
            yield batch.select(["u", "v"]).filter(good)

    left = arrays.select(F.col("node").alias("u"), F.col("hashes").alias("a"))
    right = arrays.select(F.col("node").alias("v"), F.col("hashes").alias("b"))
    both = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "a", "b")
    return both.mapInArrow(test, "u bigint, v bigint")


class Arrays:
    """Sorted arrays of the sets that pairs ask for; each is made from its text once and written."""

    def __init__(self, docs: DataFrame, members: DataFrame, words: int):
        self.docs, self.words, self.have = docs, words, None
        self.sources = members.where("row = node").select("node", "doc_id", "digest")

    def of(self, pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
        if self.have is not None:
            nodes = nodes.join(self.have.select("node"), "node", "left_anti")
        wanted = stored(self.sources.join(nodes, "node", "left_semi"), "wanted")
        if self.have is None or not wanted.isEmpty():
            made = stored(arrays_of(self.docs, wanted, self.words), "arrays")
            self.have = made if self.have is None else self.have.unionByName(made)
        return self.have


def bounded(pairs: DataFrame, maps: DataFrame, bands: Bands = BANDS) -> DataFrame:
    """The pairs (u, v) that sizes and bitmaps (``node``, ``n``, ``bits``) allow to link."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            n_a, n_b = (batch.column(k).to_pylist() for k in (2, 3))
            sets = [[np.frombuffer(x.as_py(), dtype=np.uint8) for x in batch.column(k)] for k in (4, 5)]
            good = []
            for a_size, b_size, a, b in zip(n_a, n_b, *sets):
                width = min(len(a), len(b))
                most = most_common(a_size, folded(a, width), b_size, folded(b, width)[None, :])
                good.append(bool(reaches(int(most[0]), a_size, b_size, bands)))
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    left = maps.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("bits").alias("bits_u"))
    right = maps.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("bits").alias("bits_v"))
    both = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "n_u", "n_v", "bits_u", "bits_v")
    return both.mapInArrow(test, "u bigint, v bigint")


def tile_pairs(
    tiles: DataFrame, maps: DataFrame, block: int = BLOCK, bands: Bands = BANDS, closest: bool = False
) -> DataFrame:
    """Pairs (u, v) of a tile's members (``key``, ``node``, ``label``) with different labels that sizes and
    bitmaps (``node``, ``n``, ``bits``) allow. Large tiles are cut into blocks; every two blocks meet once.
    With ``closest`` just a pair per member, that with the largest similarity that bitmaps allow."""
    sizes = tiles.groupBy("key").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    own = tiles.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    meets = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = meets.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("left"), "node", "label",
    ).join(maps, "node")

    def within(rows: list[dict], i: int, j: int) -> Iterator[tuple[int, int]]:
        """Members sorted by size; each is held against those that are larger, within the ratio."""
        rows.sort(key=lambda r: (r["n"], r["node"]))
        n = np.array([r["n"] for r in rows])
        labels, left = np.array([r["label"] for r in rows]), np.array([r["left"] for r in rows])
        maps = [np.frombuffer(r["bits"], dtype=np.uint8) for r in rows]
        width = min(map(len, maps))
        table = np.stack([folded(m, width) for m in maps])
        top, mate = np.full(len(rows), -1.0), np.zeros(len(rows), dtype=np.int64)
        for at in range(len(rows) - 1):
            end = int(np.searchsorted(n, n[at] * bands.below // bands.above, side="right"))
            near = np.arange(at + 1, end)
            near = near[labels[near] != labels[at]]
            if i != j:
                near = near[left[near] != left[at]]
            if not len(near):
                continue
            most = most_common(n[at], table[at], n[near], table[near])
            fit = reaches(most, n[at], n[near], bands)
            near, alike = near[fit], (most / (n[at] + n[near] - most))[fit]
            if not closest:
                own = rows[at]["node"]
                yield from ((max(own, rows[k]["node"]), min(own, rows[k]["node"]), 0.0) for k in near)
            elif len(near):
                best = int(alike.argmax())
                if alike[best] > top[at]:
                    top[at], mate[at] = alike[best], near[best]
                nearer = alike > top[near]
                top[near[nearer]], mate[near[nearer]] = alike[nearer], at
        for at in np.flatnonzero(top >= 0):
            yield rows[at]["node"], rows[mate[at]]["node"], float(top[at])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held, tile = [], None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                name = row["key"], row["i"], row["j"]
                if name != tile:
                    out += within(held, *tile[1:]) if len(held) > 1 else []
                    held, tile = [], name
                held.append(row)
            yield _pairs(out)
        if len(held) > 1:
            yield _pairs(list(within(held, *tile[1:])))

    sorted_ = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = sorted_.mapInArrow(scan, "u bigint, v bigint, alike double")
    if not closest:
        return found.select("u", "v").distinct()
    best = found.groupBy("u").agg(F.max(F.struct("alike", (-F.col("v")).alias("v"))).alias("best"))
    best = best.select("u", (-F.col("best.v")).alias("v"))
    return best.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _pairs(pairs: list[tuple[int, int, float]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array([p[k] for p in pairs], kind) for k, kind in enumerate(kinds)], ["u", "v", "alike"]
    )


def joined_by_closest(
    tiles: DataFrame, path: str, maps: DataFrame, arrays: Arrays, edges: DataFrame, roots: DataFrame, block: int,
    bands: Bands = BANDS,
) -> tuple[DataFrame, str, DataFrame]:
    """The tiles that are still open, with new labels, where they are written (first at ``path``), and all
    links, after rounds in which each member is held against the closest of another component. Rounds go on
    while one joins at least one component in a hundred pairs that it tests: what is left apart is tested
    pair by pair, so it must be little. A round's tiles replace those of the round before."""
    spark, joined = tiles.sparkSession, roots.count()
    while True:
        pairs = stored(tile_pairs(tiles, maps, block, bands, closest=True), "closest")
        edges = stored(edges.unionByName(verified(pairs, arrays.of(pairs), bands)), "links")
        roots, before = components(edges), joined
        joined = roots.count()
        if joined == before:
            return tiles, path, edges
        named = tiles.drop("label").join(roots, "node", "left")
        named = named.select("key", "node", F.coalesce("root", "node").alias("label"))
        apart = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        last, path = path, work_path(spark, "open")
        tiles = stored(named.join(apart.where("low <> high").select("key"), "key", "left_semi"), "open", path)
        remove(spark, last)
        if (joined - before) * 100 < pairs.count():
            return tiles, path, edges


def jaccard_components(
    docs: DataFrame, block: int = BLOCK, words: int = WORDS_PER_SHINGLE, threshold: tuple[int, int] = THRESHOLD
) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id, and ``kept`` for one row of each
    component. Sets of shingles of ``words`` words link at a Jaccard similarity of ``threshold`` (a fraction)
    and more.

    Null, empty and blank texts have an empty set and are alone, with their own doc_id as component. A
    component's id is its smallest doc_id; rows with a null id count for nothing there, and a component
    of such rows has a null id. Repeated rows have equal sets and are one component. An empty table
    gives no rows. Other columns are not read.
    """
    bands, spark = Bands(threshold), docs.sparkSession
    keyed, met_at, open_at = (work_path(spark, label) for label in ("keyed", "in_tiles", "open"))
    parts = [work_path(spark, "tiles") for _ in range(KEY_PARTS)]
    with_keys = stored(shingle_sets(docs, bands, words), "keyed", keyed)
    sets = stored(with_keys.drop("keys"), "sets")
    full = sets.where("n > 0")
    names = full.groupBy("digest").agg(F.min("row").alias("node"))
    members = stored(full.select("row", "doc_id", "text_key", "n", "digest").join(names, "digest"), "members")
    arrays = Arrays(docs, members, words)
    maps = members.where("row = node").select("row", "node", "n").join(full.select("row", "bits"), "row").drop("row")

    in_tile = Window.partitionBy("key").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys, shared = with_keys.select("row", F.explode("keys").alias("key")), None
    # A part of the keys at a time, so that not all of them lie in shuffle files at once.
    for part, path in enumerate(parts):
        tiles = keys.where(F.pmod("key", F.lit(KEY_PARTS)) == part).withColumn("first", F.first("row").over(in_tile))
        own = stored(tiles.where("row <> first"), "tiles", path)
        shared = own if shared is None else shared.unionByName(own)
    # The keys are most of what is written here, and most of them belong to one set only.
    remove(spark, keyed)
    of_row = members.select("row", "node")
    met = shared.groupBy("row", "first").agg(F.count("*").alias("times"))
    met = met.join(of_row, "row").join(of_row.select(F.col("row").alias("first"), F.col("node").alias("mate")), "first")
    met = met.where("node <> mate").groupBy("node", "mate").agg(F.sum("times").alias("times"))
    best = met.groupBy("node").agg(F.max(F.struct("times", (-F.col("mate")).alias("mate"))).alias("best"))
    first_pairs = best.select(F.col("node").alias("u"), (-F.col("best.mate")).alias("v"))
    first_pairs = stored(bounded(first_pairs, maps, bands), "met")
    edges = stored(verified(first_pairs, arrays.of(first_pairs), bands), "links")
    roots = components(edges)

    in_tiles = shared.select("key", "row").unionByName(shared.select("key", F.col("first").alias("row")))
    labels = of_row.join(roots, "node", "left").select("row", "node", F.coalesce("root", "node").alias("label"))
    in_tiles = stored(in_tiles.join(labels, "row").select("key", "node", "label").distinct(), "in_tiles", met_at)
    for path in parts:
        remove(spark, path)
    alike = in_tiles.groupBy("key").agg(
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("node")).alias("who"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("who_too"),
    )
    # Tiles of several components; of those with the same members, one.
    several = alike.where("low <> high").groupBy("members", "who", "who_too").agg(F.min("key").alias("key"))
    # Tiles hold names only, as a bitmap in each tile of its set would be most of what lies on disk.
    open_tiles = stored(in_tiles.join(several.select("key"), "key", "left_semi"), "open", open_at)
    remove(spark, met_at)
    open_tiles, open_at, edges = joined_by_closest(open_tiles, open_at, maps, arrays, edges, roots, block, bands)
    more = tile_pairs(open_tiles, maps, block, bands).join(
        first_pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), ["u", "v"], "left_anti"
    )
    more = stored(more, "more")
    remove(spark, open_at)
    edges = edges.unionByName(verified(more, arrays.of(more), bands))
    roots = components(edges)

    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    lowest = placed.groupBy("root").agg(F.min(rank).alias("low"))
    whole = placed.join(lowest, "root").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("low.id").alias("component_id"),
        (F.col("row") == F.col("low.row")).alias("kept"),
    )
    alone = sets.where("n = 0").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return whole.unionByName(alone)


def drop_near_copies(
    docs: DataFrame, words: int = WORDS_PER_SHINGLE, threshold: tuple[int, int] = THRESHOLD
) -> DataFrame:
    """The documents that stay, one of each component, with all their columns.

    Rows are found again by doc_id (null is an id like others) and a digest of the text. Of rows that are
    equal in both, all stay if their texts have no shingle, else one at most. Null, empty and blank texts
    stay. Other columns, whatever their names, are passed on. An empty table gives no rows.
    """
    found = jaccard_components(docs, words=words, threshold=threshold).groupBy("doc_id", "text_key").agg(
        F.count("*").alias("rows"), F.sum(F.col("kept").cast("int")).alias("stay")
    )
    # Few rows go, and what goes is written, so its size is known: the texts are moved only if it is large.
    found = stored(found.where("rows <> stay"), "go")
    whole = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    rows = docs.select(F.col("doc_id").alias("id"), text_key().alias("own_key"), whole)

    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key"))
    repeated = rows.join(found.where("stay > 0").select("doc_id", "text_key"), same, "left_semi")
    repeated = repeated.groupBy("id", "own_key").agg(F.first("doc").alias("doc"))
    kept = rows.join(found.select("doc_id", "text_key"), same, "left_anti").select("doc").unionByName(repeated.select("doc"))
    return kept.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def op6_jaccard_join(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, w[p:p + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0)
), z AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM c JOIN z AS x ON x.doc_id = a JOIN z AS y ON y.doc_id = b
  WHERE 100 * common >= 90 * (x.n + y.n - common)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  WITH RECURSIVE reach(doc_id, seen) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON reach.seen = e.a
  ) SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id
)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents JOIN r USING (doc_id) LEFT JOIN z USING (doc_id)
"""

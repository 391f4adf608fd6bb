"""SimHash near-duplicates: fingerprints in shards, a BK-tree per shard, edges within the radius only.

Two fingerprints that differ in at most ``RADIUS`` of 64 bits agree whole in at least 3 of the 7 blocks
that the bits are cut into, so they meet in one of the 35 shards of each that stand for three blocks and
their bits. Nothing that links can miss its shard, and chance meetings in 27 bits are few.

A shard's members hang below its smallest fingerprint, the root of its tree: members within the radius of
the root link to it at once. Shards in which that leaves several components are then searched: their trees
are built, cut into blocks of bounded size where a shard is large, with children keyed by their Hamming
distance to the parent. Members that are not of the shard's most common component are sent to each of its
blocks and follow just the edges whose key lies within the radius of their own distance; subtrees of one
component that they have joined are left out. So a large group of near copies costs a pass, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored
from tidemark.llm.components import components

WORDS_PER_SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCKS = 7
TREE_NODES = 4096
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, size: int = WORDS_PER_SHINGLE) -> int:
    """Majority of the bits of the hashes of all word shingles, as a signed long; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = [end - 1 for end in accumulate(len(word) + 1 for word in words)]
    starts = [0, *(end + 1 for end in ends[:-1])]
    last = min(size, len(words)) - 1
    spans = list(zip(starts, ends[last:]))
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(spans), HASHES_AT_ONCE):
        grams = (whole[a:b] for a, b in spans[at : at + HASHES_AT_ONCE])
        hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > len(spans), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = WORDS_PER_SHINGLE) -> DataFrame:
    """(doc_id, print) of every row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                made = pa.array([fingerprint(text, size) for text in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), made], ["doc_id", "print"])

    return docs.select("doc_id", "text").mapInArrow(make, "doc_id bigint, print bigint")


def masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """Signed masks of all choices of ``blocks - radius`` blocks."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("there must be more blocks than bits that may differ, 64 at most")
    edges = [64 * k // blocks for k in range(blocks + 1)]
    whole = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    chosen = (sum(choice) for choice in combinations(whole, blocks - radius))
    return [mask - (1 << 64) if mask >> 63 else mask for mask in chosen]


class Tree:
    """BK-tree of labelled 64-bit fingerprints (as unsigned integers)."""

    def __init__(self) -> None:
        self.prints: list[int] = []
        self.labels: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parents: list[int] = []
        self.only: list[int | None] = []

    def add(self, print_: int, label: int) -> None:
        at, new = 0, len(self.prints)
        parent = -1
        while new:
            parent = at
            distance = (print_ ^ self.prints[at]).bit_count()
            if distance == 0:
                return
            at = self.children[at].setdefault(distance, new)
            if at == new:
                break
        self.prints.append(print_)
        self.labels.append(label)
        self.children.append({})
        self.parents.append(parent)

    def close(self) -> None:
        """Notes the subtrees whose nodes have one label."""
        self.only = list(self.labels)
        for at in range(len(self.prints) - 1, 0, -1):
            if self.only[self.parents[at]] != self.only[at]:
                self.only[self.parents[at]] = None

    def within(self, print_: int, radius: int, skip) -> Iterator[int]:
        """Nodes within the radius, but those below a node that ``skip`` leaves out by its one label."""
        stack = [0] if self.prints else []
        while stack:
            at = stack.pop()
            if self.only[at] is not None and skip(self.only[at]):
                continue
            distance = (print_ ^ self.prints[at]).bit_count()
            if distance <= radius:
                yield at
            children = self.children[at]
            for key in range(max(1, distance - radius), distance + radius + 1):
                if key in children:
                    stack.append(children[key])


class Labels:
    """Which labels have been joined in a block."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, label: int) -> int:
        while (up := self.parent.get(label, label)) != label:
            label = up
        return label

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[a] = b
        return a != b


def search_block(tree: Tree, labels: Labels, print_: int, label: int, radius: int) -> Iterator[int]:
    """Fingerprints within the radius that join the label to one it has not been joined to."""
    for at in tree.within(print_, radius, lambda only: labels.find(only) == labels.find(label)):
        if labels.join(label, tree.labels[at]):
            yield tree.prints[at]


def _signed(print_: int) -> int:
    return print_ - (1 << 64) if print_ >> 63 else print_


def shard_links(members: DataFrame, radius: int, tree_nodes: int) -> DataFrame:
    """Links (u, v) that join the components of a shard's members (``choice``, ``bits``, ``print``, ``label``,
    ``common``, ``size``)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, tree, labels, asking = None, Tree(), Labels(), False
        for batch in batches:
            u, v = [], []
            for *name, asks, print_, label in zip(*(column.to_pylist() for column in batch.columns)):
                if name != block:
                    block, tree, labels, asking = name, Tree(), Labels(), False
                print_ %= 1 << 64
                if not asks:
                    tree.add(print_, label)
                    continue
                if not asking:
                    tree.close()
                    asking = True
                for hit in search_block(tree, labels, print_, label, radius):
                    u.append(_signed(print_))
                    v.append(_signed(hit))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    names = ["choice", "bits", "block", "asks", "print", "label"]
    blocks = F.ceil(F.col("size") / tree_nodes).cast("bigint")
    in_tree = members.withColumn("block", F.pmod(F.xxhash64("print"), blocks)).withColumn("asks", F.lit(False))
    asking = members.where("label <> common").withColumn("asks", F.lit(True))
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    dealt = in_tree.select(*names).unionByName(asking.select(*names))
    dealt = dealt.repartition("choice", "bits", "block").sortWithinPartitions(*names[:5])
    return dealt.mapInArrow(scan, "u bigint, v bigint")


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def print_components(prints: DataFrame, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """(node, root) of all fingerprints ``print`` that are joined to a smaller one; rows must be distinct."""
    choices = F.array(*(
        F.struct(F.lit(n).alias("choice"), F.col("print").bitwiseAND(F.lit(mask)).alias("bits"))
        for n, mask in enumerate(masks(radius))
    ))
    keyed = prints.select("print", F.explode(choices).alias("key")).select("key.choice", "key.bits", "print")
    shards = keyed.groupBy("choice", "bits").agg(F.count("*").alias("size"), F.min("print").alias("top"))
    shards = stored(shards.where("size > 1"), "shards")
    members = stored(keyed.join(shards, ["choice", "bits"]), "members")
    near_top = members.where((F.col("print") != F.col("top")) & (_apart("print", "top") <= radius))
    edges = stored(near_top.select(F.col("print").alias("u"), F.col("top").alias("v")).distinct(), "links")
    roots = components(edges)

    labelled = members.join(roots, F.col("print") == F.col("node"), "left")
    labelled = labelled.withColumn("label", F.coalesce("root", "print")).select("choice", "bits", "size", "print", "label")
    labelled = stored(labelled, "labelled")
    of_label = labelled.groupBy("choice", "bits", "label").agg(F.count("*").alias("times"))
    several = of_label.groupBy("choice", "bits").agg(
        F.count("*").alias("labels"), F.max(F.struct("times", "label")).alias("most")
    )
    several = stored(several.where("labels > 1").select("choice", "bits", F.col("most.label").alias("common")), "several")
    found = shard_links(labelled.join(several, ["choice", "bits"]), radius, tree_nodes)
    return components(edges.unionByName(found))


def simhash_components(
    docs: DataFrame, size: int = WORDS_PER_SHINGLE, radius: int = RADIUS, tree_nodes: int = TREE_NODES
) -> DataFrame:
    """One row per document: doc_id, print (long), component_id, the smallest doc_id that links reach.

    Null, empty and blank texts have fingerprint 0, which links like any other. Repeated rows have equal
    fingerprints and one component. Null ids count for nothing in a component's id, which is null where
    there is no other. An empty table gives no rows. Other columns are not read.
    """
    rows = stored(fingerprints(docs, size), "prints")
    nodes = stored(rows.groupBy("print").agg(F.min("doc_id").alias("low")), "nodes")
    roots = print_components(nodes.select("print"), radius, tree_nodes)
    placed = nodes.join(roots, F.col("print") == F.col("node"), "left").select("print", "low", F.coalesce("root", "print").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(placed.join(lowest, "root").select("print", "component_id"), "named")
    return rows.join(named, "print").select("doc_id", "print", "component_id")


def op12_simhash(docs: DataFrame) -> DataFrame:
    made = simhash_components(docs)
    return made.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")

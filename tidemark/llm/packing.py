"""Best-fit packing of token sequences with a bounded number of open bins.

Each task packs what it reads, online: a piece goes into the open bin whose free space is the
smallest that holds it. Open bins are kept by free space, and a bitset over the free spaces finds
the best one without a search. When all ``open_bins`` are in use and none fits, the fullest closes.
A bin's pieces are put out when it closes, so a task holds no more than the open bins. What is open
at the end of a task is packed once more, whole bins at a time, by fewer tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored
from tidemark.llm.tokens import encoder, public_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
CAPACITY = 1024
OPEN_BINS = 256
BINS_PER_MERGE = 16_384
PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, bin bigint, offset bigint, "
    "open boolean"
)
_KINDS = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_())
_NAMES = [part.split()[0] for part in PIECES.split(", ")]
_OF_PIECE = _NAMES[:6]


class Packer:
    """Online best fit. ``put`` places an item and returns the bin that had to close, if any.

    A bin is ``[number, filled, items]``. Of bins with equal free space the youngest is used.
    """

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.bits, self.count, self.made = 0, 0, 0

    def _take(self, free: int) -> list:
        stack = self.free[free]
        taken = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.count -= 1
        return taken

    def put(self, size: int, item) -> list[list]:
        closed = []
        fitting = self.bits >> size
        if fitting:
            chosen = self._take(size + (fitting & -fitting).bit_length() - 1)
        else:
            if self.count == self.open_bins:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            chosen = [self.made, 0, []]
            self.made += 1
        chosen[2].append((item, chosen[1]))
        chosen[1] += size
        left = self.capacity - chosen[1]
        if left == 0:
            closed.append(chosen)
        else:
            self.free[left].append(chosen)
            self.bits |= 1 << left
            self.count += 1
        return closed

    def rest(self) -> list[list]:
        return [held for stack in self.free for held in stack]


def cut(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than ``capacity``."""
    first = length % capacity or min(length, capacity)
    if first:
        yield 0, first
    for start in range(first, length, capacity):
        yield start, capacity


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)


def _rows(bins: list[list], base: int, is_open: bool) -> Iterator[tuple]:
    for number, _, items in bins:
        for pieces, offset in items:
            for *piece, within in pieces:
                yield *piece, base + number, offset + within, is_open


def pack_texts(
    docs: DataFrame,
    tokenizer: str | None = None,
    cut_rule: str | None = "spaced",
    end_id: int | None = END_ID,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, ids, sequence_id,
    offset. Without ``with_ids`` the ids are null, and only their checksum leaves the worker.

    Null and empty texts are just their end id. Repeated rows are packed as often as they occur; a null
    id stays null. An empty table gives no rows. Other columns are not read.
    """
    tokenizer = tokenizer or public_path(TOKENIZER)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer, cut_rule, end_id).encode, Packer(capacity, open_bins)
        base, out, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + length)]
                        kept = own if with_ids else None
                        closed = packer.put(length, [(doc_id, piece, start, length, zlib.crc32(own), kept, 0)])
                        out += _rows(closed, base, False)
                        held += length
                        if held > 1 << 20:
                            if out:
                                yield _batch(out)
                            out, held = [], 0
        out += _rows(packer.rest(), base, True)
        for at in range(0, len(out), 4096):
            yield _batch(out[at : at + 4096])

    packed = stored(docs.select("doc_id", "text").mapInArrow(pack, PIECES), "pieces")
    closed, left = packed.where("NOT open"), packed.where("open")
    whole = left.groupBy("bin").agg(
        F.sum("length").alias("filled"),
        F.sort_array(F.collect_list(F.struct("offset", *_OF_PIECE))).alias("pieces"),
    )
    merged = repack(whole, max(1, -(-left.select("bin").distinct().count() // BINS_PER_MERGE)), capacity, open_bins)
    return closed.unionByName(merged).select(*_OF_PIECE, F.col("bin").alias("sequence_id"), "offset")


def repack(bins: DataFrame, tasks: int, capacity: int, open_bins: int) -> DataFrame:
    """Best fit once more over bins left open: ``bin``, ``filled`` and at most ``capacity`` pieces each.

    Bins are dealt out by hash and taken in descending order of what they hold.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = Packer(capacity, open_bins), TaskContext.get().partitionId() << 32 | 1 << 62
        for batch in batches:
            out: list[tuple] = []
            for filled, pieces in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                item = [(*(p[name] for name in _OF_PIECE), p["offset"]) for p in pieces]
                out += _rows(packer.put(filled, item), base, False)
            if out:
                yield _batch(out)
        out = list(_rows(packer.rest(), base, False))
        for at in range(0, len(out), 4096):
            yield _batch(out[at : at + 4096])

    dealt = bins.repartition(tasks, F.xxhash64("bin")).sortWithinPartitions(F.desc("filled"), "bin")
    return dealt.select("filled", "pieces").mapInArrow(pack, PIECES)


def op4_packing(docs: DataFrame) -> DataFrame:
    return pack_texts(docs, with_ids=False).drop("ids")

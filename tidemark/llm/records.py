"""Token ids as length-delimited binary records with an offset index.

A record is ``length (u64) | masked crc32 of the length (u32) | payload | masked crc32 of the payload
(u32)``, little-endian throughout; a checksum is rotated right by 15 bits and a constant is added, so
that the checksum of data which itself holds checksums stays sound. The payload is ``row of doc_id
(i64) | 1 if doc_id is null (u8) | bytes per id (u8) | ids``. Beside each shard lies ``.idx``: the
offset of every record and the file's length as u64, so that a reader can take records in any order.

Shards are the partitions of a range sort by id and carry their place in that order. A task writes
files of its own attempt and reports them in its result; only reported files are read, so a task
that is run again leaves nothing behind that counts.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.tokens import encoder, public_path
from tidemark.session import work_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
MASK = 0xA282EAD8
HEAD, TAIL, LEAD = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<qBB")
MANIFEST = "shard int, file string, n_records bigint, n_tokens bigint, n_bytes bigint"
RECORDS = "shard int, record bigint, doc_id bigint, ids binary, before bigint"


class DamagedRecord(ValueError):
    """A length or checksum does not fit."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + TAIL.pack(masked(size)) + payload + TAIL.pack(masked(payload))


def pack_ids(doc_id: int | None, ids: bytes) -> bytes:
    """Payload of one document; ids are stored in two bytes where all of them fit."""
    values = np.frombuffer(ids, dtype="<u4")
    small = not len(values) or int(values.max()) < 1 << 16
    body = values.astype("<u2").tobytes() if small else ids
    return LEAD.pack(doc_id or 0, doc_id is None, 2 if small else 4) + body


def unpack_ids(payload: bytes) -> tuple[int | None, bytes]:
    doc_id, missing, width = LEAD.unpack_from(payload)
    values = np.frombuffer(payload, dtype=f"<u{width}", offset=LEAD.size)
    return None if missing else doc_id, values.astype("<u4").tobytes()


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def read_frames(stream) -> Iterator[bytes]:
    """All payloads of an open shard, in order, each checked."""
    while head := stream.read(HEAD.size):
        if len(head) < HEAD.size:
            raise DamagedRecord("cut off in a length")
        size, crc = HEAD.unpack(head)
        if masked(head[:8]) != crc:
            raise DamagedRecord("checksum of a length")
        payload, tail = stream.read(size), stream.read(TAIL.size)
        if len(payload) < size or len(tail) < TAIL.size or masked(payload) != TAIL.unpack(tail)[0]:
            raise DamagedRecord("checksum of a payload")
        yield payload


def read_at(path: str, numbers: list[int]) -> list[bytes]:
    """The payloads of some records of a shard, found through its index, in the order asked for."""
    system, place = _open(path)
    with system.open_input_file(f"{place}.idx") as index, system.open_input_file(place) as file:
        found = []
        for number in numbers:
            index.seek(8 * number)
            begin, end = struct.unpack("<QQ", index.read(16))
            file.seek(begin)
            found += read_frames(pa.BufferReader(file.read(end - begin)))
        return found


def write_records(
    docs: DataFrame, path: str, tokenizer: str | None = None, cut: str | None = "words", end_id: int | None = END_ID
) -> DataFrame:
    """Encode ``text`` and write shards in ascending doc_id order under ``path``; returns the manifest.

    Null and empty texts give just the end id; null ids come first; rows with one id are ordered by
    their text's hash, by which the range sort can also part them. An empty table gives no shard.
    """
    tokenizer = tokenizer or public_path(TOKENIZER)
    run = f"{path}/data-{uuid.uuid4().hex[:8]}"
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encode = TaskContext.get(), encoder(tokenizer, cut, end_id).encode
        file, count, tokens, offsets, at = None, 0, 0, [0], 0
        name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.rec"
        for batch in batches:
            for part in slices(batch, "text"):
                if file is None:
                    system, place = _open(run)
                    system.create_dir(place, recursive=True)
                    file = system.open_output_stream(f"{place}/{name}")
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    record = frame(pack_ids(doc_id, ids))
                    file.write(record)
                    at += len(record)
                    offsets.append(at)
                    tokens += len(ids) // 4
                    count += 1
        if file is None:
            return
        file.close()
        with system.open_output_stream(f"{place}/{name}.idx") as index:
            index.write(np.array(offsets, dtype="<u8").tobytes())
        row = [task.partitionId(), f"{run}/{name}", count, tokens, at]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
            ["shard", "file", "n_records", "n_tokens", "n_bytes"],
        )

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records under ``path``: doc_id, ids, and ``start``, the ids of all records before.

    The running sum goes over the manifest, a row per shard; within a shard the reader counts.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0).cast("long")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = _open(row["file"])
                before, held, size = row["base"], [], 0
                with system.open_input_stream(place, buffer_size=1 << 20) as stream:
                    for record, payload in enumerate(read_frames(stream)):
                        doc_id, ids = unpack_ids(payload)
                        held.append((row["shard"], record, doc_id, ids, before))
                        before += len(ids) // 4
                        size += len(ids)
                        if size > 4 << 20:
                            yield _records(held)
                            held, size = [], 0
                if held:
                    yield _records(held)

    # About one shard per task; a fixed number is not coalesced.
    return shards.repartition(max(1, manifest.count())).mapInArrow(read, RECORDS).withColumnRenamed("before", "start")


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["shard", "record", "doc_id", "ids", "before"])


def op2_records(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = work_path(spark, "records")
    write_records(docs, path)
    return read_records(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )

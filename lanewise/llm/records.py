"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A shard is a file of records. A record is the payload's length (8 bytes), a masked checksum of
those 8 bytes (4), the payload, and a masked checksum of the payload (4), all little-endian. The
checksum is CRC-32, rotated by 15 bits plus a constant, so that a checksum over bytes that hold
checksums stays sound. A payload is one byte of flags (1: has an id; 2: ids take 4 bytes, else
2), the document's id (8), and its token ids, the end id last. The index is a Parquet table
beside the shards: shard, offset and bytes of each record, doc_id, n_tokens.

Documents are dealt to tasks by ranges of doc_id, so shards in order of name hold them in order.
A task writes each shard under a name of its attempt and renames it when it is whole; a repeated
task writes the same bytes under the same name.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lanewise.llm.staging import scratch, shuffle_width
from lanewise.llm.text import chunks
from lanewise.llm.tokens import Encoder

END_ID = 0
SHARD_BYTES = 32 << 20
#: Fixed values of the format.
ROTATE, MASK = 15, 0xA282EAD8
HEAD, PAYLOAD = "<QI", "<Bq"
HAS_ID, WIDE = 1, 2

INDEX = "shard string, offset long, bytes long, doc_id long, n_tokens long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> ROTATE) | (crc << (32 - ROTATE) & 0xFFFFFFFF)) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload,
                     struct.pack("<I", masked(payload))))


def unframed(data: bytes, offset: int) -> tuple[bytes, int]:
    """The payload of the record at ``offset`` and where the next begins; checks both checksums."""
    size, check = struct.unpack_from(HEAD, data, offset)
    if masked(data[offset:offset + 8]) != check:
        raise ValueError(f"length at {offset} is damaged")
    start = offset + struct.calcsize(HEAD)
    payload = data[start:start + size]
    if len(payload) != size or masked(payload) != struct.unpack_from("<I", data, start + size)[0]:
        raise ValueError(f"record at {offset} is damaged")
    return payload, start + size + 4


def packed(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    flags = (HAS_ID if doc_id is not None else 0) | (WIDE if width == 4 else 0)
    return struct.pack(PAYLOAD, flags, doc_id or 0) + ids.astype(f"<u{width}").tobytes()


def unpacked(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack_from(PAYLOAD, payload)
    ids = np.frombuffer(payload, dtype="<u4" if flags & WIDE else "<u2", offset=struct.calcsize(PAYLOAD))
    return doc_id if flags & HAS_ID else None, ids.astype("<u4")


def storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI as Spark writes them, and the path there."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def write_records(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encodes each row of ``docs`` and writes ``folder``/shards and ``folder``/index.

    ``docs`` has doc_id and text; a null text is empty, and any document ends with ``end_id``.
    Documents are in ascending doc_id order, null ids first; rows of one id are in the order of
    a hash of their text. Special tokens aren't added. A shard holds whole records and is closed
    once it has ``shard_bytes``. No rows make no shards and an empty index.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        task = TaskContext.get()
        system, top = storage(f"{folder}/shards")
        system.create_dir(top, recursive=True)
        number, out, name, at = 0, None, "", 0
        for batch, texts in chunks(batches):
            found = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts),
                                   strict=True):
                if out is None:
                    name, at = f"part-{task.partitionId():07d}-{number:06d}.records", 0
                    unfinished = f"{top}/_{name}.{task.taskAttemptId()}"
                    out = system.open_output_stream(unfinished)
                record = framed(packed(doc_id, np.append(ids, end_id), encoder.width))
                out.write(record)
                found.append((name, at, len(record), doc_id, len(ids) + 1))
                at += len(record)
                if at >= shard_bytes:
                    out.close()
                    system.move(unfinished, f"{top}/{name}")
                    number, out = number + 1, None
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*found, strict=True),
                    [pa.string(), *[pa.int64()] * 4], strict=True)],
                names=[x.split()[0] for x in INDEX.split(", ")],
            )
        if out is not None:
            out.close()
            system.move(unfinished, f"{top}/{name}")

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id"), F.xxhash64("text")]
    (
        texts.repartitionByRange(shuffle_width(docs), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(rows, INDEX).write.parquet(f"{folder}/index")
    )


READ = (
    "shard string, offset long, doc_id long, before long, n_tokens long, ids_crc32 long, "
    "ids array<int>"
)


def read_records(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """The records of a folder, read by their index and checked.

    Returns shard, offset, doc_id, start (ids of all records before it, in order of shard and
    offset), n_tokens, ids_crc32 (unsigned CRC-32 of the ids as little-endian 32-bit integers)
    and ids (null unless ``with_ids``). Raises an error for a damaged record.
    """
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = storage(f"{folder}/shards")
        name, data, before = None, b"", 0
        for batch in batches:
            found = []
            for shard, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                     strict=True):
                if shard != name:
                    with system.open_input_stream(f"{top}/{shard}") as stream:
                        data = stream.read()
                    name, before = shard, 0
                doc_id, ids = unpacked(unframed(data, offset)[0])
                found.append((shard, offset, doc_id, before, len(ids), zlib.crc32(ids.tobytes()),
                              ids.tolist() if with_ids else None))
                before += len(ids)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*found, strict=True),
                        [pa.string(), *[pa.int64()] * 5, pa.list_(pa.int32())], strict=True)],
                    names=[x.split()[0] for x in READ.split(", ")],
                )

    records = (
        index.select("shard", "offset").repartition(shuffle_width(index), "shard")
        .sortWithinPartitions("shard", "offset").mapInArrow(rows, READ)
    )
    # One row per shard, of tens of megabytes each: the only rows that are put in one order.
    sizes = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    in_order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "shard", F.coalesce(F.sum("total").over(in_order), F.lit(0)).alias("shard_start")
    )
    return records.join(sizes, "shard").select(
        "shard", "offset", "doc_id", (F.col("shard_start") + F.col("before")).alias("start"),
        "n_tokens", "ids_crc32", "ids",
    )


def token_records(docs: DataFrame, vocabulary: str, folder: str | None = None) -> DataFrame:
    """Writes ``docs`` as records and returns what reading them gives, a row per document."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "records")
    write_records(docs, folder, vocabulary)
    return read_records(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")

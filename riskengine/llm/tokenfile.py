"""Files of token ids, each id in the fewest bits that hold every id of the vocabulary.

A file is: the header (magic, version, bits per id, ids per block, numbers of ids, documents and blocks), the document
table (id, null flag, first id) and the block table (byte offset of each block), then the blocks. A block holds a fixed
number of ids, little-endian and bit by bit without gaps, and ends on a byte, so any id is found by its block's offset
and unpacked with numpy alone.

Files are cells of a Parquet table: Spark's writer then commits whole files whatever executor is lost, on any store.
Documents are in ascending id (nulls first; equal ids by the text's hash) over the files by ``first_doc``, and a file
holds a bounded number of ids, or one document if it is longer than that.

Rules for odd input: a null text counts as empty, so it is its end id; repeated rows are documents of their own; an
empty table gives no file and no rows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.llm.common import parts_for, slices, written
from riskengine.llm.tokens import release, vocabulary, word_ids

MAGIC, VERSION = b"TOKBITS\0", 1
HEADER = struct.Struct("<8sIIQQQQ")
BLOCK_IDS = 1 << 14
IDS_PER_FILE = 1 << 21
DOCS_PER_PART = 8_000
MOST_PARTS = 100_000
#: Up to so many files, their starts are sent to every task; beyond that, the files are joined with them.
BROADCAST_FILES = 100_000


def bits_for(vocabulary_size: int) -> int:
    return max(1, int(vocabulary_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids of ``bits`` bits one after another, least bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(wide.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return (each.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


def write_file(documents: list[tuple[int | None, np.ndarray]], bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """The bytes of one file."""
    ids = np.concatenate([d[1] for d in documents]) if documents else np.zeros(0, np.uint32)
    firsts = np.cumsum([0] + [len(d[1]) for d in documents])[:-1]
    blocks = [pack_bits(ids[a : a + block_ids], bits) for a in range(0, len(ids), block_ids)]
    tables = np.array([d[0] or 0 for d in documents], "<i8").tobytes() + bytes(d[0] is None for d in documents) + firsts.astype("<u8").tobytes()
    start = HEADER.size + len(tables) + 8 * (len(blocks) + 1)
    offsets = start + np.cumsum([0] + [len(b) for b in blocks])
    header = HEADER.pack(MAGIC, VERSION, bits, block_ids, len(ids), len(documents), len(blocks))
    return b"".join([header, tables, offsets.astype("<u8").tobytes(), *blocks])


class TokenFile:
    """Reads documents or any span of ids of one file."""

    def __init__(self, data: bytes):
        magic, version, self.bits, self.block_ids, self.n_ids, n_docs, n_blocks = HEADER.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file of this version")
        self.data, at = data, HEADER.size
        self.doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        self.nulls = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
        self.firsts = np.append(np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64), self.n_ids)
        self.offsets = np.frombuffer(data, "<u8", n_blocks + 1, at + 17 * n_docs).astype(np.int64)

    def ids(self, first: int, end: int) -> np.ndarray:
        """The ids from ``first`` up to ``end``; only their blocks are read."""
        if first >= end:
            return np.zeros(0, np.uint32)
        a, b = first // self.block_ids, (end - 1) // self.block_ids
        out = [
            unpack_bits(self.data[self.offsets[k] : self.offsets[k + 1]], self.bits, min(self.block_ids, self.n_ids - k * self.block_ids))
            for k in range(a, b + 1)
        ]
        return np.concatenate(out)[first - a * self.block_ids : end - a * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.firsts[k]), int(self.firsts[k + 1]))


def _cuts(docs: DataFrame, docs_per_part: int) -> list[int]:
    """Document ids that cut the table into parts of about ``docs_per_part`` rows; at most ``MOST_PARTS`` of them."""
    rows = docs.count()
    parts = min(MOST_PARTS, parts_for(rows, docs_per_part))
    if parts < 2:
        return []
    steps = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), steps, 10 * parts).alias("cuts")).first().cuts
    return sorted(set(found or []))


def write_tokens(
    docs: DataFrame, out: str, path: str, end_id: int, ids_per_file: int = IDS_PER_FILE, docs_per_part: int = DOCS_PER_PART
) -> None:
    """Tokenizes documents and writes them under ``out``."""
    bits = bits_for(max(vocabulary(path), end_id + 1))
    cuts = np.array(_cuts(docs, docs_per_part), np.int64)
    sent = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("hash", T.LongType()),
         T.StructField("n", T.IntegerType()), T.StructField("packed", T.BinaryType())]
    )

    def tokenize(batches):
        release()
        own = word_ids(path)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            parts = [0 if d is None else 1 + int(np.searchsorted(cuts, d, "left")) for d in doc_ids]
            for first, end, data, offsets in slices(batch.column(1)):
                flat, counts = own.encode(data, offsets, end_id)
                ids = np.split(flat, np.cumsum(counts)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(parts[first:end], pa.int32()),
                        pa.array(doc_ids[first:end], pa.int64()),
                        pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                        pa.array(counts, pa.int32()),
                        pa.array([pack_bits(i, bits) for i in ids], pa.binary()),
                    ],
                    names=sent.names,
                )

    files = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("number", T.IntegerType()), T.StructField("first_doc", T.LongType()),
         T.StructField("n_ids", T.LongType()), T.StructField("file", T.BinaryType())]
    )

    def build(batches):
        part, number, held, size = None, 0, [], 0

        def cell():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([held[0][0]], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([write_file(held, bits)], pa.binary())],
                names=files.names,
            )

        for batch in batches:
            for p, doc_id, n, packed in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if held and (p != part or size + n > ids_per_file):
                    yield cell()
                    number, held, size = number + 1 if p == part else 0, [], 0
                if p != part:
                    part, number = p, 0
                held.append((doc_id, unpack_bits(packed, bits, n)))
                size += n
        if held:
            yield cell()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tokenize, sent)
    # A task per part, so that no task grows with the table.
    ordered = source.repartition(len(cuts) + 2, "part").sortWithinPartitions("part", "doc_id", "hash")
    ordered.mapInArrow(build, files).write.mode("overwrite").option("compression", "none").parquet(out)


def read_tokens(spark, out: str, with_ids: bool = True) -> DataFrame:
    """The documents of the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, unless turned
    off, ids."""
    table = spark.read.parquet(out)
    # One small row per file: the ids in all files before it, by part first.
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    by_part = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_part_start"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = table.select("part", "number", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("_start")).join(by_part, "part")
    if starts.count() <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    placed = table.join(starts, ["part", "number"]).select((F.col("_start") + F.col("_part_start")).alias("start"), "file")
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    schema = T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                at, own = batch.column(0)[k].as_py(), TokenFile(batch.column(1)[k].as_py())
                found = [own.document(i).astype("<u4").tobytes() for i in range(len(own.doc_ids))]
                columns = [
                    pa.array(own.doc_ids, pa.int64(), mask=own.nulls),
                    pa.array(at + own.firsts[:-1], pa.int64()),
                    pa.array(np.diff(own.firsts), pa.int64()),
                    pa.array([zlib.crc32(f) for f in found], pa.int64()),
                    pa.array(found, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns[: len(schema)], names=schema.names)

    return placed.mapInArrow(run, schema)

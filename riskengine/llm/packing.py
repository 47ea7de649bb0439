"""Packs documents into sequences of a fixed number of tokens by patterns of lengths.

Only the histogram of piece lengths (at most ``size`` bins) decides how to pack. Patterns of one, two or three lengths
that fill a sequence exactly are enumerated; non-negative least squares finds how often to repeat each so that the
histogram is met, the counts are rounded down and cut to what is there, and this is done again on what remains while
it helps. The residual pieces are packed best fit, longest first, also by length. The plan is a few thousand
rows whatever the number of documents. Each piece then finds its place by its rank among pieces of its length, which
is counted in blocks, so a length that a third of all pieces share is no hot spot.

Rules for odd input: a null text counts as empty; a document is its ids and the end id, so it is never empty; repeated
rows are pieces of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.llm.common import clashing, parts_for, slices, written
from riskengine.llm.tokens import release, word_ids

ROWS_PER_BLOCK = 50_000
#: Steps of the least-squares solver, and rounds of solving and rounding.
STEPS, ROUNDS = 200, 4
#: Lengths below this share of a sequence weigh less: they fill gaps easily.
SHORT, SHORT_WEIGHT = 1 / 8, 0.1


def patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """Index triples of one, two or three of ``lengths`` that add up to ``size``; -1 where there are fewer."""
    at = np.full(size + 1, -1)
    at[lengths] = np.arange(len(lengths))
    found = [np.array([[at[size], -1, -1]])] if at[size] >= 0 else []
    a = lengths[lengths * 2 >= size]
    a = a[a < size]
    a = a[at[size - a] >= 0]
    found.append(np.stack([at[a], at[size - a], np.full(len(a), -1)], 1))
    for x in lengths[(lengths * 3 >= size) & (lengths < size)]:
        y = lengths[(lengths <= x) & (lengths * 2 >= size - x) & (lengths < size - x)]
        y = y[at[size - x - y] >= 0]
        found.append(np.stack([np.full(len(y), at[x]), at[y], at[size - x - y]], 1))
    return np.concatenate(found).astype(np.int64)


def nnls(index: np.ndarray, target: np.ndarray, weights: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 that makes the weighted squares of (counts of the patterns - target) small: accelerated projected
    gradient steps on the sparse pattern matrix."""
    n = len(target)
    padded = np.where(index < 0, n, index)
    w = np.append(weights**2, 0.0)

    def counts(x):
        return np.bincount(padded.ravel(), np.repeat(x, index.shape[1]), n + 1)[:n]

    # The largest eigenvalue, by power iteration, gives the step.
    v = np.ones(len(index))
    for _ in range(12):
        u = (w * np.append(counts(v), 0.0))[padded].sum(1)
        norm = np.linalg.norm(u)
        v = u / max(norm, 1e-12)
    rate = 1 / max(norm * 1.1, 1e-12)
    x = y = np.zeros(len(index))
    t = 1.0
    for _ in range(steps):
        gradient = (w * np.append(counts(y) - target, 0.0))[padded].sum(1)
        new = np.maximum(0, y - rate * gradient)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / s * (new - x)
        x, t = new, s
    return x


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packs ``left[l]`` pieces of each length l, longest first, each into the fullest sequence that takes it."""
    room: dict[int, list[list]] = {}  # free tokens: [lengths, number of sequences]
    free = np.zeros(size + 1, bool)

    def put(at, lengths, count):
        room.setdefault(at, []).append([lengths, count])
        free[at] = True

    for length in range(size, 0, -1):
        count = int(left[length])
        while count:
            at = length + int(np.argmax(free[length:]))
            if not free[at]:
                put(size - length, (length,), count)
                break
            lengths, number = room[at][-1]
            taken = min(count, number)
            if taken == number:
                room[at].pop()
                if not room[at]:
                    free[at] = False
            else:
                room[at][-1][1] -= taken
            put(at - length, (*lengths, length), taken)
            count -= taken
    return [(tuple(lengths), number) for entries in room.values() for lengths, number in entries if number]


def plan(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """How to pack: pairs of lengths that share a sequence, and how many such sequences. Uses every piece once."""
    left = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    out = []
    for _ in range(ROUNDS):
        lengths = np.flatnonzero(left)
        if not len(lengths):
            break
        index = patterns(lengths, size)
        if not len(index):
            break
        weights = np.where(lengths < size * SHORT, SHORT_WEIGHT, 1.0)
        x = np.floor(nnls(index, left[lengths].astype(float), weights) + 1e-6).astype(np.int64)
        placed = 0
        for p in np.argsort(-x, kind="stable"):
            if not x[p]:
                break
            own = lengths[index[p][index[p] >= 0]]
            values, each = np.unique(own, return_counts=True)
            times = min(int(x[p]), int((left[values] // each).min()))
            if times:
                left[values] -= each * times
                out.append((tuple(sorted(map(int, own), reverse=True)), times))
                placed += times
        if not placed:
            break
    return out + best_fit(left, size)


def token_pieces(docs: DataFrame, path: str, end_id: int, size: int, with_ids: bool = True) -> DataFrame:
    """Documents as pieces of at most ``size`` tokens: doc_id, piece, start, length, ids_crc32 and, unless turned off,
    the ids as little-endian unsigned 32-bit integers."""
    fields = [("doc_id", T.LongType()), ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    schema = T.StructType([T.StructField(*f) for f in fields] + [T.StructField("ids", T.BinaryType())] * with_ids)

    def run(batches):
        release()
        own = word_ids(path)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, _, data, offsets in slices(batch.column(1)):
                ids, counts = own.encode(data, offsets, end_id)
                ends = np.cumsum(counts)
                rows = []
                for doc_id, a, b in zip(doc_ids[first:], (ends - counts).tolist(), ends.tolist()):
                    for piece, at in enumerate(range(a, b, size)):
                        part = ids[at : min(at + size, b)].tobytes()
                        rows.append((doc_id, piece, at - a, len(part) // 4, zlib.crc32(part), part)[: len(schema)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()])],
                    names=schema.names,
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pack(pieces: DataFrame, size: int, length: str = "length", rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``. Lengths are from 1 to ``size``. The input is read more than once: hand in a
    written table."""
    pieces = clashing(pieces, ["sequence_id", "offset"])
    histogram = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}  # at most ``size`` rows
    blocks = parts_for(sum(histogram.values()), rows_per_block)
    places: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequences = 0
    for lengths, times in plan(histogram, size):
        offset = 0
        for own in lengths:
            first = used.get(own, 0)
            places.setdefault(own, []).append((first, sequences, offset))
            used[own], offset = first + times, offset + own
        sequences += times
    tables = {own: tuple(np.array(c) for c in zip(*rows)) for own, rows in places.items()}

    cols = [c for c in pieces.columns if c != "ids"]
    block = pieces.withColumn("_block", F.pmod(F.xxhash64(*cols), F.lit(blocks)))
    counts = block.groupBy(F.col(length).alias("_length"), "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_length"), F.col("_block").alias("_b"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = Window.partitionBy(length, "_block").orderBy(*cols)
    ranked = block.withColumn("_rank", F.row_number().over(local)).join(
        starts, (F.col(length) == F.col("_length")) & (F.col("_block") == F.col("_b"))
    )
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before") - 1).drop("_block", "_b", "_length", "_before")
    kept = [f for f in ranked.schema if f.name != "_rank"]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        for batch in batches:
            own = batch.column(batch.schema.get_field_index(length)).to_numpy()
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
            sequence, offset = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
            for value in np.unique(own):
                rows = np.flatnonzero(own == value)
                firsts, bases, offsets = tables[int(value)]
                at = np.searchsorted(firsts, rank[rows], "right") - 1
                sequence[rows] = bases[at] + rank[rows] - firsts[at]
                offset[rows] = offsets[at]
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, size: int = 2048, with_ids: bool = True) -> DataFrame:
    """Tokenizes, cuts and packs."""
    return pack(written(token_pieces(docs, path, end_id, size, with_ids), "pieces"), size)

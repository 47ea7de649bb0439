"""Byte-level BPE encoding and decoding with a rank queue over a hierarchical bitmap.

All new pieces of a slice are merged together. The bytes of the pieces form linked lists; every adjacent pair that has
a merge stands, by its left position, in the bucket of its rank. A bitmap of three levels of 64-bit words marks the
buckets in use, so the next rank is found by three find-first-set steps. Merging a position relinks its list and files
the two new pairs; entries that no longer describe a live pair of that rank are skipped when they come up. The order of
merges within a piece is that of the rank, then from left to right, whatever the other pieces do. The work is
proportional to the bytes of a piece, also for a piece of a megabyte.

Encoded chunks and pieces are remembered per worker in two generations of bounded size.

Rules for odd input: a null text counts as empty and gives no ids; repeated rows are encoded alike; result columns
replace input columns of the same name, others pass through.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.llm.common import Pieces, clashing, distinct_spans, list_column, per_group, slices

REMEMBERED = 120_000


class RankQueue:
    """Buckets of positions by rank; the least rank in use comes first."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        words = (ranks >> 6) + 1
        self.low = [0] * words
        self.mid = [0] * ((words >> 6) + 1)
        self.top = 0

    def fill(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Files many positions, given in ascending order."""
        order = np.argsort(ranks, kind="stable")
        values, firsts = np.unique(ranks[order], return_index=True)
        for rank, bucket in zip(values.tolist(), np.split(positions[order], firsts[1:])):
            self.push(rank, -1)
            self.buckets[rank] = bucket.tolist()

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            word = rank >> 6
            self.low[word] |= 1 << (rank & 63)
            self.mid[word >> 6] |= 1 << (word & 63)
            self.top |= 1 << (word >> 6)
        else:
            bucket.append(position)

    def first(self) -> int:
        """The least rank, or -1."""
        if not self.top:
            return -1
        block = (self.top & -self.top).bit_length() - 1
        bits = self.mid[block]
        word = (block << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return (word << 6) + (bits & -bits).bit_length() - 1

    def take(self, rank: int) -> list[int]:
        word = rank >> 6
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.mid[word >> 6] &= ~(1 << (word & 63))
            if not self.mid[word >> 6]:
                self.top &= ~(1 << (word >> 6))
        return self.buckets.pop(rank)


class Merger:
    """Ranks of tokens, and for each pair of tokens the token they merge to."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.size = max(self.tokens) + 1
        self.byte = np.array([ranks[bytes([b])] for b in range(256)])
        self.pairs = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        self.merged: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.merged[left * self.size + right] = rank

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece; pieces are independent of each other."""
        if not pieces:
            return []
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n, size, get = len(data), self.size, self.merged.get
        token = self.byte[data].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ends = np.cumsum([len(p) for p in pieces])
        starts = ends - [len(p) for p in pieces]
        edge = np.zeros(n + 1, np.uint8)
        edge[ends], edge[starts] = 1, 1
        first, last, live = bytearray(edge), bytearray(edge[1:]), bytearray(b"\1") * n
        queue = RankQueue(size)
        push = queue.push
        ranks = self.pairs[data[:-1], data[1:]]
        at = np.flatnonzero((ranks >= 0) & (edge[1:n] == 0))
        queue.fill(ranks[at], at)
        while (rank := queue.first()) >= 0:
            for i in sorted(queue.take(rank)):
                # Stale: the left token is gone, is the last of its piece, or the pair is another one by now.
                if not live[i] or last[i]:
                    continue
                j = after[i]
                if get(token[i] * size + token[j]) != rank:
                    continue
                token[i], live[j] = rank, 0
                k = after[i] = after[j]
                if last[j]:
                    last[i] = 1
                else:
                    before[k] = i
                    new = get(rank * size + token[k])
                    if new is not None:
                        push(new, i)
                if not first[i]:
                    p = before[i]
                    new = get(token[p] * size + rank)
                    if new is not None:
                        push(new, p)
        out = []
        for i, end in zip(starts.tolist(), ends.tolist()):
            ids = []
            while i < end:
                ids.append(token[i])
                i = after[i]
            out.append(ids)
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token, a space, its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Encoder:
    """Texts to ids; remembers what it has encoded.

    A text is looked up in chunks that begin at ASCII white space after something else. No match of the pattern goes
    on from other characters into white space, so a chunk's matches do not depend on its neighbours.
    """

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        self.merger = Merger(read_ranks(path))
        self.pattern = regex.compile(pattern)
        self.remembered, self.young, self.old = remembered, {}, {}

    def learn(self, chunks: list[bytes]) -> None:
        """Sees to it that every chunk is remembered."""
        young = self.young
        new = [c for c in chunks if not self.known(c)]
        matches = [[m.encode() for m in self.pattern.findall(c.decode("utf-8", "replace"))] for c in new]
        pieces = [p for p in {p for c in matches for p in c} if not self.known(p)]
        for piece, ids in zip(pieces, self.merger.encode(pieces)):
            young[piece] = np.array(ids, np.int32).tobytes()
        for chunk, parts in zip(new, matches):
            if parts != [chunk]:
                young[chunk] = b"".join([young[p] for p in parts])

    def known(self, part: bytes) -> bool:
        if part in self.young:
            return True
        ids = self.old.get(part)
        if ids is not None:
            self.young[part] = ids
        return ids is not None

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents of a slice one after another, and how many each has."""
        starts = chunk_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        chunks, which = distinct_spans(data, starts, ends)
        self.learn(chunks)
        found = [self.young[c] for c in chunks]
        if len(self.young) > self.remembered:
            self.young, self.old = {}, self.young
        pieces = Pieces(np.frombuffer(b"".join(found), np.int32), np.fromiter(map(len, found), np.int64, len(found)) // 4)
        ids, counts = pieces.gather(which)
        docs = np.searchsorted(offsets, starts, "right") - 1
        return ids, per_group(counts, docs, len(offsets) - 1)


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: at every document, and at ASCII white space that does not follow white space.

    What follows a character that may be other white space (or begins with the same two bytes as one) begins no chunk.
    """
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    blank = space | ((data >= 0x1C) & (data <= 0x1F))
    start = space.copy()
    start[1:] &= ~blank[:-1]
    if len(data) > 2:
        wide = np.zeros(len(data), bool)
        wide[1:] = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        first, second = data[:-2], data[1:-1]
        wide[2:] |= (first >= 0xE1) & (first <= 0xE3) & ((second == 0x9A) | (second == 0x80) | (second == 0x81))
        start[1:] &= ~wide[:-1]
    start[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(start)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(maxsize=2)
def token_table(path: str) -> Pieces:
    """The bytes of each id."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return Pieces(np.frombuffer(b"".join(table), np.uint8), np.array([len(t) for t in table]))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids``, an array of token ids; the text column is dropped."""
    kept = clashing(docs, [ids]).withColumnRenamed(text, "_text")
    schema = T.StructType([f for f in kept.schema if f.name != "_text"] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches):
        own = encoder(path, pattern)
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            for first, end, data, offsets in slices(batch.column(at)):
                rest = [batch.column(i).slice(first, end - first) for i in range(batch.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, list_column(*own.encode(data, offsets), pa.int32())], names=[*names, ids])

    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``, the bytes that the ids stand for."""
    kept = clashing(encoded, [out])
    schema = T.StructType([*kept.schema, T.StructField(out, T.BinaryType(), False)])

    def run(batches):
        table = token_table(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            ends = column.offsets.to_numpy()
            values = column.values.to_numpy()
            decoded = [table.gather(values[a:b])[0].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, out])

    return kept.mapInArrow(run, schema)


def digests(decoded: DataFrame, ids: str = "ids", out: str = "decoded") -> DataFrame:
    return decoded.withColumns(
        {
            "n_tokens": F.size(ids).cast("long"),
            "ids_sha256": F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256),
            "decoded_sha256": F.sha2(F.col(out), 256),
        }
    ).drop(ids, out)

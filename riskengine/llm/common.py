"""What the operators of this folder share: working tables, keys for rows, and texts as byte arrays.

Texts reach a task as Arrow batches. ``slices`` cuts a batch into runs of documents of a few MB, so memory does not
grow with the batch; every document is whole within one slice. Words and hashes of a slice are numpy arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.session import shared_dir

SLICE_BYTES = 1 << 20
#: Random values of bytes and the base of the rolling hash; any odd base will do.
_VALUES = np.random.default_rng(20240101).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so later steps read it and lost executors cost nothing."""
    path = shared_dir(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(df: DataFrame, column: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``."""
    return F.crc32(df[column].cast("string").cast("binary")) % mod


def row_key(id_column: Column, text: Column) -> list[Column]:
    """Two longs that tell rows apart by id and text. Rows equal in both share a key. Never null."""
    low = F.lit(-(2**63))
    return [F.coalesce(id_column.cast("long"), low).alias("_k1"), F.xxhash64(id_column, text).alias("_k2")]


def parts_for(rows: int, each: int) -> int:
    return max(1, -(-int(rows) // each))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents: first row, end row, their bytes, and the offsets of the documents in them. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; other bytes stay."""
    return _LOWER[data]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept between calls."""
    while len(_POWERS[0]) < n:
        for i, base in ((0, _BASE), (1, pow(_BASE, -1, 2**64))):
            now = _POWERS[i]
            step = np.uint64(pow(base, len(now), 2**64))
            _POWERS[i] = np.concatenate([now, now * step])
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Hashes:
    """64-bit hashes of any spans of ``data`` that depend on the span's bytes alone."""

    def __init__(self, data: np.ndarray):
        power, self._inverse = _powers(len(data) + 1)  # shared, so not to be written to
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * power[: len(data)], out=self._sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts])

    def grams(self, size: int) -> np.ndarray:
        """The hash at every position that has ``size`` bytes from it on."""
        n = max(0, len(self._sums) - size)
        return mix((self._sums[size:] - self._sums[:n]) * self._inverse[:n]) if n else np.zeros(0, np.uint64)


def spans_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs where ``inside`` holds, none crossing a document, and their documents."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if n else inside
    after = np.concatenate([inside[1:], [False]]) if n else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+``: starts, ends, documents."""
    return spans_of(~_SPACE[data], offsets)


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct byte strings among the spans, and for each span its number among them. Spans are told apart by
    64-bit hashes and length; a slice holds far too few for two to meet by chance."""
    hashes = Hashes(data).spans(starts, ends)
    _, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(starts[index].tolist(), ends[index].tolist())], inverse


class Pieces:
    """Arrays laid end to end, to be put together again in any order."""

    def __init__(self, values: np.ndarray, counts: np.ndarray):
        self.values, self.counts = values, np.asarray(counts, np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces ``which`` one after another, and the length of each."""
        counts = self.counts[which]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[which] - (ends - counts), counts)
        at += np.arange(total)
        return self.values[at], counts


def per_group(counts: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Sums of whole numbers by group."""
    return np.bincount(group, counts, groups).astype(np.int64)


def binary_column(pieces: list[bytes]) -> pa.Array:
    return pa.array(pieces, pa.binary())


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def clashing(df: DataFrame, added: list[str]) -> DataFrame:
    """Drops input columns that carry the name of a result column."""
    names = {a.lower() for a in added}
    return df.drop(*[c for c in df.columns if c.lower() in names])


SAFE_NAME = re.compile(r"[^A-Za-z0-9_]+")

"""Removes passages that repeat, found with sorted suffixes.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts elsewhere. Not every suffix is sorted:

1. Anchors. Every string of LENGTH bytes has an anchor, the position in it whose ``GRAM``-byte hash is least (the
   first of equals). It depends on the string's bytes alone, so equal strings have their anchor at the same place.
   Neighbouring strings mostly share an anchor; a run of strings (from, to) with one anchor is one row.
2. Anchors whose gram occurs once in the corpus are done: nothing that contains them repeats.
3. The others are grouped by their gram, with the bytes around them, and in each group two arrays are sorted: the
   suffixes from the anchor on, and the prefixes before it read backwards. Deep-shallow sorting: multikey
   quicksort, eight bytes at a time, down to ``SHALLOW`` bytes; groups that still agree go into a blind trie, which
   keeps only the places where its strings branch. The string that starts ``o`` bytes before an anchor repeats if
   another anchor agrees with it on at least o bytes backwards and LENGTH - o bytes forwards. Both are runs in the
   sorted arrays, cut where neighbours agree on fewer bytes, so the strings are equal if and only if they are in the
   same run in both arrays.
4. Repeating strings are merged into spans per document.

A gram that occurs more than ``HOT`` times would fill one task. Its strings are told apart before sorting: for each
string a hash of all its bytes is counted, and those found more than once are repeats.

Rules for odd input: a null text is empty; texts are UTF-8 bytes and may be cut within a character; rows are documents of
their own also when they repeat an id or are equal; matches never cross documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.llm.common import Hashes, clashing, parts_for, row_key, slices, written

LENGTH, GRAM, SHALLOW = 200, 32, 48
ROWS_PER_GROUP = 12_000
HOT = 50_000
ROW_KEYS = ["_k1", "_k2"]


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbouring values."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """For each run of strings with one anchor: document, gram hash, and within the document the anchor's place and the
    first and last start of the run."""
    grams = Hashes(data).grams(gram)
    high = np.uint64(0xFFFFFFFF00000000)
    least = least_in_windows((grams & high) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(len(at))
    doc = np.searchsorted(offsets, start, "right") - 1
    inside = start + length <= offsets[doc + 1]
    start, at, doc = start[inside], at[inside], doc[inside]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    own, base = at[first], offsets[doc[first]]
    return doc[first], grams[own].view(np.int64) if len(own) else np.zeros(0, np.int64), own - base, start[first] - base, start[last] - base


class BlindTrie:
    """A trie that knows only the depths at which its strings branch and the bytes they branch on. A search compares
    nothing on its way down; one comparison with the leaf it ends at shows where the new string leaves."""

    def __init__(self, first: bytes):
        self.root = (first, [0])

    @staticmethod
    def agree(a: bytes, b: bytes) -> int:
        if a == b:
            return len(a)
        return len(a) - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8

    def add(self, text: bytes, number: int) -> None:
        node = self.root
        while isinstance(node, list):
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        depth = self.agree(node[0], text)
        if depth == len(text):
            node[1].append(number)
            return
        above, node = None, self.root
        while isinstance(node, list) and node[0] < depth:
            above, node = node, node[1][text[node[0]]]
        if isinstance(node, list) and node[0] == depth:
            node[1][text[depth]] = (text, [number])
            return
        leaf = node
        while isinstance(leaf, list):
            leaf = next(iter(leaf[1].values()))
        branch = [depth, {leaf[0][depth]: node, text[depth]: (text, [number])}]
        if above is None:
            self.root = branch
        else:
            above[1][text[above[0]]] = branch

    def order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out += node[1]
        return out


def deep_shallow_sort(rows: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """The order of the rows of a matrix of bytes."""
    n, width = rows.shape
    order, group = np.arange(n), np.zeros(n, np.int64)
    for depth in range(0, min(shallow, width), 8):
        # Multikey quicksort: within groups that agree so far, by the next eight bytes.
        part = np.zeros((n, 8), np.uint8)
        part[:, : min(8, width - depth)] = rows[:, depth : depth + 8]
        key = part.view(">u8").ravel().astype(np.uint64)
        order = order[np.lexsort((key[order], group[order]))]
        new = np.ones(n, bool)
        new[1:] = (group[order][1:] != group[order][:-1]) | (key[order][1:] != key[order][:-1])
        group[order] = np.cumsum(new)
        if new.all():
            return order
    if width <= shallow:
        return order
    bounds = np.append(np.flatnonzero(np.diff(group[order], prepend=-1)), n)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > 1:
            own = order[a:b]
            trie = BlindTrie(rows[own[0], shallow:].tobytes())
            for k in range(1, b - a):
                trie.add(rows[own[k], shallow:].tobytes(), k)
            order[a:b] = own[trie.order()]
    return order


def agreements(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many bytes each row in order shares with the one before it; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 4096):
        b = min(len(order), a + 4096)
        differ = rows[order[a:b]] != rows[order[a - 1 : b - 1]]
        out[a:b] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def _matrix(texts: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(texts), width), np.uint8)
    for i, t in enumerate(texts):
        out[i, : min(width, len(t))] = t[:width]
    return out


def repeats(around: list[bytes], ahead: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For anchors with the bytes around them (``ahead`` bytes stand before the anchor): the least and the greatest o
    for which the string that starts o bytes before the anchor repeats among them; -1 where none does. Only o from
    ``low`` to ``high`` are strings of the anchor."""
    texts = [np.frombuffer(t, np.uint8) for t in around]
    right = _matrix([t[a:] for t, a in zip(texts, ahead)], length)
    left = _matrix([t[:a][::-1] for t, a in zip(texts, ahead)], length - gram)
    orders = [deep_shallow_sort(right), deep_shallow_sort(left)]
    shared = [agreements(right, orders[0]), agreements(left, orders[1])]
    n = len(around)
    least, greatest = np.full(n, -1), np.full(n, -1)
    place = np.arange(n)
    for o in range(int(low.min()), int(high.max()) + 1):
        who = np.flatnonzero((low <= o) & (o <= high))
        if len(who) < 2:
            continue
        runs = []
        for order, agree, depth in zip(orders, shared, (length - o, o)):
            run = np.empty(n, np.int64)
            run[order] = np.maximum.accumulate(np.where(agree < depth, place, 0))
            runs.append(run[who])
        key = runs[0] * n + runs[1]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        twice = np.zeros(len(who), bool)
        twice[by[1:][same]] = True
        twice[by[:-1][same]] = True
        own = who[twice]
        least[own] = np.where(least[own] < 0, o, least[own])
        greatest[own] = o
    return least, greatest


def _spans_in_group(length: int, gram: int):
    def run(table: pa.Table) -> pa.Table:
        at, low, high = (table.column(c).to_numpy() for c in ("at", "first", "last"))
        near, far = repeats(table.column("bytes").to_pylist(), at - low, at - high, at - low, length, gram)
        keep = near >= 0
        return pa.table(
            {**{k: table.column(k).filter(pa.array(keep)) for k in ROW_KEYS}, "start": (at - far)[keep], "end": (at - near + length)[keep]}
        )

    return run


def _around(length: int):
    """Documents with their anchors to the bytes of each."""

    def run(batches):
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            found = columns["found"]
            ends = found.offsets.to_numpy()
            fields = {f: found.values.field(f).to_numpy() for f in ("gram", "at", "first", "last")}
            for row in range(batch.num_rows):
                text = columns["_text"][row].as_buffer() if columns["_text"][row].is_valid else b""
                own = slice(int(ends[row]), int(ends[row + 1]))
                n = own.stop - own.start
                text = memoryview(text)
                pieces = [bytes(text[a : b + length]) for a, b in zip(fields["first"][own].tolist(), fields["last"][own].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([columns[k][row].as_py()] * n, pa.int64()) for k in ROW_KEYS), *(pa.array(fields[f][own]) for f in fields), pa.array(pieces, pa.binary())],
                    names=[*ROW_KEYS, *fields, "bytes"],
                )

    return run


def _cut(length: int, text: str, names: list[str]):
    """Merges a document's spans and takes them out."""

    def run(batches):
        for batch in batches:
            at = batch.schema.names.index("_text")
            spans = batch.column(batch.schema.names.index("_spans"))
            removed, kept = [], []
            for value, own in zip(batch.column(at), spans):
                data = value.as_buffer().to_pybytes() if value.is_valid else b""
                merged: list[list[int]] = []
                for s in sorted((x["start"], x["end"]) for x in own.as_py() or []):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                inner = [0, *(x for s in merged for x in s), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(inner[::2], inner[1::2])))
                removed.append([{"start": a, "end": b} for a, b in merged])
            rest = [batch.column(batch.schema.names.index(n)) for n in names]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*rest, pa.array(kept, pa.binary()), pa.array(removed, kind)], names=[*names, "kept_bytes", "removed"])

    return run


def remove_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Adds ``kept_bytes`` (the text's bytes without repeats) and ``removed`` (the maximal removed spans); the text
    column is dropped."""
    keyed = clashing(docs, ["kept_bytes", "removed", "_text", "_spans", *ROW_KEYS])
    keyed = keyed.select(*row_key(F.col(id_column), F.col(text)), *[c for c in keyed.columns if c != text], F.col(text).alias("_text"))
    # Rows equal in id and text share a key; they are documents of their own, which repeat each other.
    texts = keyed.select(*ROW_KEYS, "_text").filter(F.octet_length("_text") >= length)

    def find(batches):
        for batch in batches:
            for row, _, data, offsets in slices(batch.column(2)):
                doc, *found = anchors(data, offsets, length, gram)
                keys = [batch.column(i).take(pa.array(doc + row)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*keys, *(pa.array(f) for f in found)], names=[*ROW_KEYS, "gram", "at", "first", "last"])

    rows = texts.mapInArrow(find, "_k1 long, _k2 long, gram long, at long, first long, last long")
    rows = written(rows.withColumns({c: F.col(c).cast("int") for c in ("at", "first", "last")}), "anchors")
    counts = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(rows.join(counts, "gram"), "shared-anchors")
    # A key's anchors come from each of its equal rows; they are gathered once, as the join brings the rows back.
    by_doc = shared.groupBy(*ROW_KEYS).agg(F.collect_set(F.struct("gram", "at", "first", "last")).alias("found"))
    pieces = written(
        texts.join(by_doc, ROW_KEYS).select(*ROW_KEYS, "found", "_text").mapInArrow(
            _around(length), "_k1 long, _k2 long, gram long, at int, first int, last int, bytes binary"
        ),
        "pieces",
    )
    found_spans = "_k1 long, _k2 long, start long, end long"
    hot = written(counts.filter(F.col("n") > HOT).select("gram"), "hot-grams")
    groups = parts_for(shared.count(), ROWS_PER_GROUP)
    cold = pieces.join(hot, "gram", "left_anti").withColumn("_group", F.pmod(F.xxhash64("gram"), F.lit(groups)))
    spans = cold.groupBy("_group").applyInArrow(_spans_in_group(length, gram), found_spans)
    if hot.limit(1).count():
        spans = spans.unionByName(_hot_spans(pieces.join(hot, "gram", "left_semi"), length))
    by_doc = spans.groupBy(*ROW_KEYS).agg(F.collect_set(F.struct("start", "end")).alias("_spans"))
    joined = keyed.join(by_doc, ROW_KEYS, "left").drop(*ROW_KEYS)
    names = [c for c in joined.columns if c not in ("_text", "_spans")]
    schema = T.StructType([joined.schema[n] for n in names] + [T.StructField("kept_bytes", T.BinaryType()), T.StructType.fromDDL("removed array<struct<start: long, end: long>>")["removed"]])
    return joined.mapInArrow(_cut(length, text, names), schema)


def _hot_spans(pieces: DataFrame, length: int) -> DataFrame:
    """Strings of very frequent grams: each is counted by a hash of all its bytes, aggregated before the shuffle."""

    def run(batches):
        for batch in batches:
            first, last = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            for row, end, data, offsets in slices(batch.column(6)):
                size = last[row:end] - first[row:end] + 1
                who = np.repeat(np.arange(end - row), size)
                step = np.arange(len(who)) - np.repeat(np.cumsum(size) - size, size)
                begin = offsets[who] + step
                every = Hashes(data)
                other = Hashes(data[::-1].copy())  # a second hash, of the reversed bytes
                codes = every.spans(begin, begin + length), other.spans(len(data) - begin - length, len(data) - begin)
                keys = [batch.column(i).take(pa.array(who + row)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array((first[row:end][who] + step).astype(np.int64)), *(pa.array(c.view(np.int64)) for c in codes)],
                    names=[*ROW_KEYS, "start", "h1", "h2"],
                )

    strings = pieces.select(*ROW_KEYS, "gram", "at", "first", "last", "bytes").mapInArrow(run, "_k1 long, _k2 long, start long, h1 long, h2 long")
    twice = strings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2")
    return strings.join(twice, ["h1", "h2"]).select(*ROW_KEYS, "start", (F.col("start") + length).alias("end"))


def digests(cut: DataFrame) -> DataFrame:
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return cut.select(
        "doc_id",
        (F.length("kept_bytes") + n_removed).cast("long").alias("n_bytes"),
        n_removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
    )

"""Ranked lexical search of many items at once, sharing what their scores have in common.

Items are a query set; documents are met in blocks of items. For each block:

1. *Mine*: terms that stand in the same items, and pairs of terms or earlier sets that several items share, become nodes
   of a graph, the most shared first. An item is the sum of few nodes.
2. *Postings*: one pass over all documents keeps, of each, its length and how often it holds the block's terms, and
   counts documents per term.
3. *Score*: one pass over the postings. For a run of documents every node's accumulator, a whole number per document, is
   made once from those of its two parts, level by level; an item's scores add up its nodes. A task keeps the best
   ``k`` documents of an item over all its runs; a ranking per item over the tasks' lists gives the result.

Memory is bounded by the block of items and the run of documents. All arithmetic is on 64-bit integers, so the order of
addition does not matter and sharing changes no score.

Rules for odd input: null texts have no terms; rows of one item_id (null included) are one item with the terms of all;
each document row counts as a document, also repeated ones; equal scores are ordered by doc_id, null last; items without
terms and empty tables give no rows; other columns of either table are not read.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.common import Hashes, list_column, lower, parts_for, slices, spans_of, written

#: Fixed value: what may stand in a term.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of item texts that are searched for at once.
BLOCK_BYTES = 1 << 20
#: Pairs are mined among so many terms of an item that follow each other in order of sharing. Only effort depends on it.
RUN = 16
#: Bytes of accumulators at a time, and candidates kept before the best are chosen.
ACCUMULATORS, CANDIDATES = 48 << 20, 400_000

_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Shared:
    """Items as sums over a graph whose nodes are terms or sums of two nodes.

    Nodes below ``terms`` are the terms; ``left`` and ``right`` are the parts of the others, ordered by ``levels`` (the
    first node of each level, and the end). The nodes of item i are ``children[starts[i]:starts[i + 1]]``.
    """

    def __init__(self, items: list[list[int]], terms: int, run: int = RUN):
        self.terms = terms
        self._left: list[int] = []
        self._right: list[int] = []
        children = self._mine(items, run)
        self._arrange(children)

    def _node(self, a: int, b: int) -> int:
        self._left.append(a)
        self._right.append(b)
        return self.terms + len(self._left) - 1

    def _mine(self, items: list[list[int]], run: int) -> list[list[int]]:
        holders = defaultdict(list)
        for i, own in enumerate(items):
            for term in sorted(set(own)):
                holders[term].append(i)
        together = defaultdict(list)
        for term, held in holders.items():
            together[tuple(held)].append(term)
        children: list[list[int]] = [[] for _ in items]
        atoms: list[list[tuple[int, int]]] = [[] for _ in items]
        for held, members in sorted(together.items()):
            if len(held) == 1:
                children[held[0]] += members
                continue
            while len(members) > 1:
                paired = [self._node(a, b) for a, b in zip(members[::2], members[1::2])]
                members = paired + members[len(paired) * 2 :]
            for i in held:
                atoms[i].append((-len(held), members[0]))
        sets: list[set[int]] = []
        for own in atoms:
            own.sort()
            sets += [{a for _, a in own[first : first + run]} for first in range(0, len(own), run)]
        owners = [i for i, own in enumerate(atoms) for _ in range(0, len(own), run)]
        self._pair_up(sets)
        for i, own in zip(owners, sets):
            children[i] += sorted(own)
        return children

    def _pair_up(self, sets: list[set[int]]) -> None:
        """Replaces the pair that most sets hold by a node for it, as long as two sets hold one."""
        places: dict[tuple[int, int], set[int]] = defaultdict(set)
        for s, own in enumerate(sets):
            ordered = sorted(own)
            for i, a in enumerate(ordered):
                for b in ordered[i + 1 :]:
                    places[a, b].add(s)
        heap = [(-len(held), pair) for pair, held in places.items() if len(held) > 1]
        heapq.heapify(heap)
        while heap:
            count, pair = heapq.heappop(heap)
            held = places.get(pair, ())
            if len(held) < 2:
                continue
            if len(held) != -count:
                heapq.heappush(heap, (-len(held), pair))
                continue
            new, changed = self._node(*pair), set()
            for s in sorted(places.pop(pair)):
                own = sets[s]
                own.difference_update(pair)
                for other in own:
                    for part in pair:
                        places[min(part, other), max(part, other)].discard(s)
                    places[other, new].add(s)
                    changed.add((other, new))
                own.add(new)
            for key in changed:
                if len(places[key]) > 1:
                    heapq.heappush(heap, (-len(places[key]), key))

    def _arrange(self, children: list[list[int]]) -> None:
        level = [0] * self.terms
        for a, b in zip(self._left, self._right):
            level.append(1 + max(level[a], level[b]))
        own = np.array(level[self.terms :], np.int64)
        order = np.argsort(own, kind="stable")
        place = np.arange(self.terms + len(order))
        place[self.terms + order] = self.terms + np.arange(len(order))
        self.left = place[np.array(self._left, np.int64)[order]]
        self.right = place[np.array(self._right, np.int64)[order]]
        self.levels = self.terms + np.append(np.flatnonzero(np.diff(own[order], prepend=0)), len(order))
        self.starts = np.cumsum([0, *map(len, children)])
        self.children = place[np.array([c for own in children for c in own], np.int64)]
        del self._left, self._right

    @property
    def nodes(self) -> int:
        return self.terms + len(self.left)

    def additions(self) -> int:
        return len(self.left) + len(self.children) - (len(self.starts) - 1)

    def scores(self, impacts: np.ndarray) -> np.ndarray:
        """Sums for each item and document; ``impacts`` has a row per node, of which the terms' are filled in."""
        for first, end in zip(self.levels[:-1].tolist(), self.levels[1:].tolist()):
            at = slice(first - self.terms, end - self.terms)
            np.add(impacts[self.left[at]], impacts[self.right[at]], out=impacts[first:end])
        return np.add.reduceat(impacts[self.children], self.starts[:-1], axis=0)


class Terms:
    """The terms of a block of items, to be found in texts."""

    def __init__(self, terms: list[bytes]):
        ends = np.cumsum([0, *map(len, terms)])
        hashes = Hashes(np.frombuffer(b"".join(terms), np.uint8)).spans(ends[:-1], ends[1:])
        self.order = np.argsort(hashes)
        self.hashes, self.lengths = hashes[self.order], np.diff(ends)[self.order]

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms in each document of a slice, then the documents, terms and counts of the block's terms."""
        small = lower(data)
        starts, ends, docs = spans_of(_IN_TERM[small], offsets)
        n = np.bincount(docs, minlength=len(offsets) - 1)
        hashes = Hashes(small).spans(starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        held = (self.hashes[at] == hashes) & (self.lengths[at] == ends - starts)
        keys, tf = np.unique(docs[held] * len(self.hashes) + self.order[at[held]], return_counts=True)
        return n, keys // len(self.hashes), keys % len(self.hashes), tf


_POSTINGS = (
    "ids array<bigint>, lengths array<int>, held array<int>, terms array<int>, tf array<int>, found array<int>, in_docs array<int>"
)


def _postings(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """One row per slice of documents: ids and lengths, how many of the terms each holds, these terms and their counts;
    and the distinct terms with the number of documents that hold them."""

    def lists(values: np.ndarray) -> pa.Array:
        return list_column(values, np.array([len(values)]), pa.int32())

    def run(batches):
        own = Terms(terms)
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(1)):
                n, at, term, tf = own.postings(data, offsets)
                found, in_docs = np.unique(term, return_counts=True)
                ids = pa.ListArray.from_arrays(pa.array([0, end - first], pa.int32()), batch.column(0).slice(first, end - first))
                rest = (n, np.bincount(at, minlength=end - first), term, tf, found, in_docs)
                names = ["ids", "lengths", "held", "terms", "tf", "found", "in_docs"]
                yield pa.RecordBatch.from_arrays([ids, *map(lists, rest)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _POSTINGS)


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.kept = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
        self.new: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        """Scores by item and document."""
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.new.append([item, scores[item, doc], ids[doc], unnamed[doc]])
        self.size += len(item)
        if self.size > CANDIDATES:
            self.choose()

    def choose(self) -> list[np.ndarray]:
        item, score, doc, unnamed = (np.concatenate(c) for c in zip(self.kept, *self.new))
        order = np.lexsort((doc, unnamed, -score, item))
        item = item[order]
        first = np.searchsorted(item, item, "left")
        order, place = order[(keep := np.arange(len(item)) - first < self.k)], (np.arange(len(item)) - first)[keep]
        self.kept = [item[keep], score[order], doc[order], unnamed[order]]
        # Once an item has k documents, others must come up to the last of them.
        last = place == self.k - 1
        self.least[self.kept[0][last]] = self.kept[1][last]
        self.new, self.size = [], 0
        return self.kept


def _best(postings: DataFrame, shared: Shared, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best documents of each item among those of a task."""
    each = max(1, ACCUMULATORS // (8 * (shared.nodes + len(shared.children))))

    def runs(row) -> Iterator[tuple]:
        ids, lengths, held, terms, tf = (c.values for c in row)
        held, terms, tf = held.to_numpy(), terms.to_numpy().astype(np.int64), tf.to_numpy().astype(np.int64)
        m = 50 + 50 * lengths.to_numpy().astype(np.int64) * n_docs // n_terms
        ends = np.cumsum(held)
        impact = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, held)))
        unnamed = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        doc = np.repeat(np.arange(len(held)), held)
        for first in range(0, len(held), each):
            end = min(first + each, len(held))
            at = slice(ends[first] - held[first], ends[end - 1])
            impacts = np.zeros((shared.nodes, end - first), np.int64)
            impacts[terms[at], doc[at] - first] = impact[at]
            yield shared.scores(impacts), ids[first:end], unnamed[first:end]

    def run(batches):
        best = Best(len(shared.starts) - 1, k)
        for batch in batches:
            for i in range(batch.num_rows):
                for scores, ids, unnamed in runs([batch.column(c)[i] for c in range(5)]):
                    best.add(scores, ids, unnamed)
        item, score, doc, unnamed = best.choose()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(doc, pa.int64(), mask=unnamed), pa.array(score, pa.int64())],
            names=["item", "doc_id", "score"],
        )

    return postings.select("ids", "lengths", "held", "terms", "tf").mapInArrow(run, "item int, doc_id bigint, score bigint")


def mined(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The items in blocks of like size: per block its number, the item ids, the terms and the graph."""
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(small, F.lit("")), F.lit(f"({TERM})")))
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    block = F.pmod(F.xxhash64("item_id"), F.lit(parts_for(total, block_bytes))).cast("int")
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), found.alias("terms")).withColumn("block", block)

    def mine(table: pa.Table) -> pa.Table:
        terms_of: dict = defaultdict(set)
        for item, own in zip(table.column("item_id").to_pylist(), table.column("terms").to_pylist()):
            terms_of[item].update(own)
        ids = sorted((i for i in terms_of if terms_of[i]), key=lambda i: (i is None, i or 0))
        terms = sorted({t for own in terms_of.values() for t in own})
        number = {t: n for n, t in enumerate(terms)}
        graph = Shared([[number[t] for t in terms_of[i]] for i in ids], len(terms))
        values = [[table.column("block")[0].as_py()], [pickle.dumps((ids, [t.encode() for t in terms], graph))]]
        return pa.table(values, schema=pa.schema([("block", pa.int32()), ("graph", pa.binary())]))

    return rows.groupBy("block").applyInArrow(mine, "block int, graph binary")


def search(docs: DataFrame, items: DataFrame, k: int = 50, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    graphs = written(mined(items, block_bytes), "item-graphs")
    found = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for row in graphs.select("block").orderBy("block").collect():
        ids, terms, shared = pickle.loads(graphs.filter(F.col("block") == row.block).first().graph)
        if not ids:
            continue
        postings = written(_postings(docs, terms), "postings")
        whole = postings.select(F.explode("lengths").alias("n")).filter("n > 0").agg(F.count("n").alias("docs"), F.sum("n").alias("terms")).first()
        if not whole.docs:
            continue
        df = np.zeros(len(terms), np.int64)
        held = postings.select(F.inline(F.arrays_zip("found", "in_docs"))).groupBy("found").agg(F.sum("in_docs").alias("n"))
        for r in held.collect():
            df[r.found] = r.n
        # Logarithms as the C library has them.
        weights = np.array([math.floor(1000 * math.log((2 * whole.docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        best = _best(postings, shared, weights, whole.docs, whole.terms, k)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = F.broadcast(spark.createDataFrame(list(enumerate(ids)), "item int, item_id bigint"))
        found = found.unionByName(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return found

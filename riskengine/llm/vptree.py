"""Nearest neighbours by cosine with one vantage-point tree per shard.

On unit vectors the Euclidean distance orders like the cosine and obeys the triangle inequality. A shard's vectors are
split at the median distance to a vantage point again and again down to leaves; a search skips a side when the
triangle inequality shows that it holds nothing nearer than the k-th found so far. The bound is multiplied by
``factor``: 1 gives the exact result, a larger factor skips more and may miss some. Queries go through a tree in blocks:
each node works on the queries that still need it, as a matrix product.

Vectors are dealt to shards of bounded size by a hash, so no vector, label or copy makes a shard large. Queries are cut
into blocks as well, and a task holds one shard and one block.

Rules for odd input: vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do
vectors whose length differs from the query's; equal scores go by the smaller id, however many they are; repeated ids count as separate
candidates, but never a query's own id; a null id takes no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.llm.common import parts_for

LEAF = 128
ROWS_PER_SHARD = 8_192
QUERIES_PER_BLOCK = 1_024
#: Rounding never hides a tie: squared distances come from matrix products and are off by some 1e-15, so distances near
#: zero are off by the root of that. What lies within the slack of the k-th is settled by the exact score.
SLACK = 1e-6
#: Pairs of vectors that are scored exactly at once.
PAIRS = 8_192


class Tree:
    """A vantage-point tree over the rows of ``unit``. Exact scores are those of ``vectors``, of any length."""

    def __init__(self, unit: np.ndarray, ids: np.ndarray, leaf: int = LEAF, vectors: np.ndarray | None = None):
        self.order = np.arange(len(unit))
        self.nodes: list[tuple] = []  # (vantage row, radius, inner node, outer node) or (first, end)
        self.unit, self.ids, self.leaf = unit, ids, leaf
        self.vectors = unit if vectors is None else vectors
        self.root = self._build(0, len(unit))
        self.sorted = self.unit[self.order]

    def _build(self, first: int, end: int) -> int:
        me = len(self.nodes)
        self.nodes.append(())
        if end - first <= self.leaf:
            self.nodes[me] = (first, end)
            return me
        rows = self.order[first:end]
        centre = self.unit[rows].mean(0)
        vantage = rows[np.argmax(((self.unit[rows] - centre) ** 2).sum(1))]  # a corner cuts better than the middle
        away = np.sqrt(np.maximum(0, 2 - 2 * self.unit[rows] @ self.unit[vantage]))
        half = (end - first) // 2
        by = np.argpartition(away, half)
        self.order[first:end] = rows[by]
        inner, outer = away[by[:half]], away[by[half:]]
        bounds = (inner.min(), inner.max(), outer.min(), outer.max())
        children = self._build(first, first + half), self._build(first + half, end)
        self.nodes[me] = (int(vantage), bounds, *children)
        return me

    def search(
        self, queries: np.ndarray, own: np.ndarray, k: int, factor: float = 1.0, asked: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact cosines of the ``k`` nearest of each query (unit vectors), equal ones by the smaller id; rows
        are -1 where there are fewer. ``own`` holds the ids that each query leaves out, ``asked`` the queries as scored."""
        n = len(queries)
        scores = np.full((n, k), -np.inf)
        found = np.full((n, k), -1, np.int64)
        farthest = np.full(n, np.inf)  # distance of the k-th
        asked = queries if asked is None else asked
        stack = [(self.root, np.arange(n), np.zeros(n))]
        while stack:
            node, who, bound = stack.pop()
            # What lies at least ``bound`` away helps only those whose k-th is farther.
            need = bound * factor <= farthest[who] + SLACK
            who = who[need]
            if not len(who):
                continue
            if len(self.nodes[node]) == 2:
                first, end = self.nodes[node]
                self._leaf(first, end, queries, own, asked, who, scores, found, farthest, k)
                continue
            vantage, (in_min, in_max, out_min, out_max), inner, outer = self.nodes[node]
            bound = bound[need]
            away = np.sqrt(np.maximum(0, 2 - 2 * queries[who] @ self.unit[vantage]))
            to_inner = np.maximum(bound, np.maximum(away - in_max, in_min - away))
            to_outer = np.maximum(bound, np.maximum(away - out_max, out_min - away))
            near = to_inner <= to_outer
            # The nearer side of each query is searched first, so the last pushed.
            stack += [(outer, who[near], to_outer[near]), (inner, who[~near], to_inner[~near])]
            stack += [(outer, who[~near], to_outer[~near]), (inner, who[near], to_inner[near])]
        return found, scores

    def _leaf(self, first, end, queries, own, asked, who, scores, found, farthest, k) -> None:
        rows = self.order[first:end]
        away = 2 - 2 * queries[who] @ self.sorted[first:end].T
        away[own[who][:, None] == self.ids[rows][None, :]] = np.inf
        limit = farthest[who] ** 2
        if len(rows) >= k:
            limit = np.minimum(limit, np.partition(away, k - 1, axis=1)[:, k - 1])
        # All that may be among the k nearest, ties and all, are ordered by exact score and id.
        at, col = np.nonzero((away <= limit[:, None] + SLACK**2) & (away < np.inf))
        if not len(at):
            return
        row = rows[col]
        score = [cosine(asked[who[at[i : i + PAIRS]]], self.vectors[row[i : i + PAIRS]]) for i in range(0, len(at), PAIRS)]
        hit, at = np.unique(at, return_inverse=True)
        hit = who[hit]
        old, place = np.nonzero(found[hit] >= 0)
        at, row = np.concatenate([at, old]), np.concatenate([row, found[hit[old], place]])
        score = np.concatenate([*score, scores[hit[old], place]])
        order = np.lexsort((self.ids[row], -score, at))
        at, row, score = at[order], row[order], score[order]
        place = np.arange(len(at)) - np.searchsorted(at, at, "left")
        top = place < k
        scores[hit[at[top]], place[top]], found[hit[at[top]], place[top]] = score[top], row[top]
        farthest[hit] = np.sqrt(np.maximum(0, 2 - 2 * scores[hit, -1]))


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # By the largest component first, so squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    scale_a, scale_b = np.abs(a).max(1, keepdims=True), np.abs(b).max(1, keepdims=True)
    a, b = a / scale_a, b / scale_b
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    factor: float = 1.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    rows_per_shard: int = ROWS_PER_SHARD,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest of each query, its own id left out."""

    def side(df):
        good = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        return good.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("d", F.size("v"))

    base, asked = side(vectors), side(queries)
    sizes = {r.d: r for r in base.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per vector length
    asks = {r.d: r.n for r in asked.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = T.StructType(
        [T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())]
    )
    spark = vectors.sparkSession
    out = spark.createDataFrame([], schema)

    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=schema.names)
        ids, v = left.column("id").to_numpy(), _matrix(left.column("v"))
        sort = np.argsort(ids, kind="stable")
        ids, v = ids[sort], v[sort]
        own, q = right.column("id").to_numpy(), _matrix(right.column("v"))
        rows, scores = Tree(_unit(v), ids, vectors=v).search(_unit(q), own, k, factor, q)
        who, at = np.nonzero(rows >= 0)
        return pa.Table.from_arrays([pa.array(own[who]), pa.array(ids[rows[who, at]]), pa.array(scores[who, at])], names=schema.names)

    for d, n in sorted(asks.items()):
        if d not in sizes:
            continue
        shards, blocks = parts_for(sizes[d].n, rows_per_shard), parts_for(n, queries_per_block)
        part = lambda name, count: F.pmod(F.xxhash64("id", "v"), F.lit(count)).cast("int").alias(name)
        trees = base.filter(F.col("d") == d).select("id", "v", part("shard", shards), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        sent = asked.filter(F.col("d") == d).select("id", "v", part("block", blocks), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        found = trees.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInArrow(run, schema)
        out = out.unionByName(found)
    first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

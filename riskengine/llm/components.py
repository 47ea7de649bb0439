"""Connected components of a table of edges, by alternating large-star and small-star steps.

Each step is a minimum per vertex, which is aggregated before its shuffle, and a join with those minima, so a vertex
with very many edges is neither gathered nor sent around whole. Steps are written tables.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.common import written


def forest(edges: list[tuple[int, int]]) -> dict[int, int]:
    """The least vertex that each vertex of the edges is connected with."""
    up: dict[int, int] = {}

    def root(v):
        r = v
        while up.setdefault(r, r) != r:
            r = up[r]
        while up[v] != r:
            up[v], v = r, up[v]
        return r

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {v: root(v) for v in up}


def _shorten(batches):
    """Edges of one batch as stars around the least vertex."""
    for batch in batches:
        found = forest(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
        pairs = [(v, r) for v, r in found.items() if v != r]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component): the least vertex reachable from every vertex of the edges ``a``, ``b`` (longs)."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    now = written(pairs.mapInArrow(_shorten, "a long, b long").distinct(), "edges")
    while True:
        # Every vertex, with all its neighbours: larger ones are linked to the least of them all.
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, both.a == least.u).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # Every vertex, with its smaller neighbours: they and it are linked to the least of them.
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(least, large.a == least.u).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        new = written(small.union(least.select("u", "m")).distinct(), "small-star")
        sums = [t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for t in (now, new)]
        now = new
        if sums[0] == sums[1]:
            return now.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("component")).unionByName(
                now.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
            )

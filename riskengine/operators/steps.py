"""Step functions as tables: what holds on an interval of a number or of time, and which interval a row falls in.

A table of steps has, per key (or for all), disjoint intervals ``[lo, hi)`` of longs with a payload; a null ``hi`` has no
end. No interval is gathered into an array and none is read by the driver; the driver sees the cuts of the range buckets,
of which there are at most ``MOST_CUTS``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.operators.joins import SALTS, fits_broadcast, spread
from riskengine.operators.prefix import prefix_sums, with_buckets
from riskengine.session import stored

MOST_CUTS = 16_384
#: Keys with no more intervals than this are joined by key alone, and the interval is tested.
FEW_STEPS = 64
#: Fan-out of the time tree.
FAN = 16


def steps_of(bounds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Steps (keys, lo, hi, hit) of the least hit at each value.

    ``bounds`` has the keys, ``v``, and ``up`` (a hit of all values from ``v`` on) or ``down`` (of all values below it).
    Bounds that never decide leave no step.
    """
    lowest = F.lit(-(2**63))
    first = bounds.select(*keys).distinct() if keys else bounds.sparkSession.range(1).select()
    kind = bounds.schema["up"].dataType
    base = first.withColumns({"v": lowest, "up": F.lit(None).cast(kind), "down": F.lit(None).cast(kind)})
    at = bounds.select(*keys, "v", "up", "down").unionByName(base).groupBy(*keys, "v").agg(F.min("up").alias("up"), F.min("down").alias("down"))
    up = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys).orderBy(F.col("v").desc()).rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy(*keys).orderBy("v")
    hit = F.array_min(F.array_compact(F.array(F.min("up").over(up), F.min("down").over(down))))
    runs = at.select(*keys, "v", hit.alias("hit"))
    changes = runs.withColumn("_same", F.lag("hit").over(order).eqNullSafe(F.col("hit")) & (F.row_number().over(order) > 1)).filter("NOT _same")
    return changes.select(*keys, F.col("v").alias("lo"), F.lead("v").over(order).alias("hi"), "hit").filter("hit IS NOT NULL")


def _inside(at: Column, lo: Column, hi: Column) -> Column:
    return (at >= lo) & (hi.isNull() | (at < hi))


def _met(points: DataFrame, steps: DataFrame, at: str, on: Sequence[str], payload: Sequence[str], spread_by: str) -> DataFrame:
    """A left join on ``on`` with the interval tested; the steps are broadcast if they are small, else spread."""
    left, right, keys = points, steps, list(on)
    if fits_broadcast(steps):
        right = F.broadcast(steps)
    else:
        left = points.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
        right = spread(steps)
        keys.append("_salt")
    left, right = left.alias("p"), right.alias("s")
    same = reduce(and_, [F.col(f"p.{k}") == F.col(f"s.{k}") for k in keys])
    met = left.join(right, same & _inside(F.col(f"p.{at}"), F.col("s.lo"), F.col("s.hi")), "left")
    return met.select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"s.{c}") for c in payload])


def _cuts(steps: DataFrame, n: int) -> list[float]:
    """All beginnings of steps, or quantiles of them."""
    if n <= MOST_CUTS:
        return sorted({float(r.lo) for r in steps.select("lo").distinct().collect()})
    share = [i / MOST_CUTS for i in range(1, MOST_CUTS)]
    return sorted(set(steps.agg(F.percentile_approx(F.col("lo").cast("double"), share, 4 * MOST_CUTS).alias("c")).first().c))


def find_step(points: DataFrame, steps: DataFrame, at: str, payload: Sequence[str], spread_by: str, keys: Sequence[str] = ()) -> DataFrame:
    """Adds the payload of the step that each point falls in, null where there is none. ``steps`` should be stored."""
    if not keys:
        n = steps.count()
        if not n:
            return points.select("*", *[F.lit(None).cast(steps.schema[c].dataType).alias(c) for c in payload])
        cuts = _cuts(steps, n)
        # A long as a double keeps its order, so a step touches the buckets from that of its first to that of its last value.
        first = with_buckets(steps, "lo", cuts).withColumnRenamed("_bucket", "_from")
        last = with_buckets(first.withColumn("_end", F.coalesce(F.col("hi") - 1, F.lit(2**63 - 1))), "_end", cuts)
        cut = last.withColumn("_bucket", F.explode(F.sequence(F.col("_from").cast("int"), F.col("_bucket").cast("int"))))
        own = with_buckets(points, at, cuts).withColumn("_bucket", F.col("_bucket").cast("int"))
        return _met(own, cut.select("_bucket", "lo", "hi", *payload), at, ["_bucket"], payload, spread_by).drop("_bucket")
    most = steps.groupBy(*keys).count().agg(F.max("count").alias("n"), F.count(F.lit(1)).alias("keys")).first()
    if (most.n or 0) <= FEW_STEPS:
        return _met(points, steps, at, keys, payload, spread_by)
    return _asof(points, steps, at, payload, spread_by, list(keys), most["keys"])


def _asof(points: DataFrame, steps: DataFrame, at: str, payload: Sequence[str], spread_by: str, keys: list[str], n_keys: int) -> DataFrame:
    """The same for long step tables: points and steps are put in one order per key, and each point takes the last step.

    Keys are spread over as many places as it takes to keep all tasks busy, and steps repeated in each.
    """
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(SALTS, -(-2 * tasks // max(1, n_keys)))
    left = points.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(at).alias("_at"), F.lit(1).alias("_kind"),
        F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int").alias("_salt"), F.struct(*points.columns).alias("_point"),
    )
    right = steps.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("lo").alias("_at"), F.lit(0).alias("_kind"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"), F.struct("hi", *payload).alias("_step"),
    )
    order = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))], "_salt").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    both = left.unionByName(right, allowMissingColumns=True)
    both = both.withColumn("_last", F.last("_step", ignorenulls=True).over(order)).filter("_point IS NOT NULL")
    holds = F.col("_at").isNotNull() & reduce(and_, [F.col(f"_k{i}").isNotNull() for i in range(len(keys))])
    holds = holds & (F.col("_last.hi").isNull() | (F.col("_at") < F.col("_last.hi")))
    return both.select("_point.*", *[F.when(holds, F.col(f"_last.{c}")).alias(c) for c in payload])


def numbered(times: DataFrame) -> DataFrame:
    """Distinct times (``at``) as steps (lo, hi, _leaf) from each to the next, numbered from 0 in order, in ranges side by side."""
    ranked = prefix_sums(times.withColumn("_one", F.lit(1).cast("long")), "at", ["_one"])
    ranked = stored(ranked.select(F.col("at").alias("lo"), F.col("_one_before").cast("long").alias("_leaf")), "rule-numbers")
    following = ranked.select(F.col("lo").alias("hi"), (F.col("_leaf") - 1).alias("_leaf"))
    return ranked.join(following, "_leaf", "left").select("lo", "hi", "_leaf")


def levels_for(leaves: int) -> int:
    """Levels of a tree of fan-out ``FAN`` over so many leaves."""
    levels = 1
    while FAN**levels < leaves:
        levels += 1
    return levels


def tree_nodes(begin: str, end: str, levels: int) -> Column:
    """The nodes ``(level, node)`` that make up the leaves ``[begin, end)``: few per level, none below another."""
    parts = []
    for level in range(levels):
        size, above = FAN**level, FAN ** (level + 1)
        i, j = f"(({begin} + {size - 1}) div {size})", f"({end} div {size})"
        if level + 1 < levels:
            i2, j2 = f"(({begin} + {above - 1}) div {above})", f"({end} div {above})"
        else:
            i2, j2 = "1", "0"
        one, two = f"least({i2} * {FAN}, {j})", f"greatest({j2} * {FAN}, {i})"
        nodes = (
            f"CASE WHEN {i} >= {j} THEN array() WHEN {i2} >= {j2} THEN sequence({i}, {j} - 1) ELSE "
            f"concat(CASE WHEN {i} < {one} THEN sequence({i}, {one} - 1) ELSE array() END, "
            f"CASE WHEN {two} < {j} THEN sequence({two}, {j} - 1) ELSE array() END) END"
        )
        parts.append(f"transform({nodes}, n -> named_struct('level', {level}, 'node', CAST(n AS BIGINT)))")
    return F.expr(f"concat({', '.join(parts)})")


def least_over_time(versions: DataFrame, key: str) -> DataFrame:
    """Steps (key, lo, hi, hit) in time of the least hit in force, from versions (key, valid_from, valid_to, hit).

    The changes of a key are numbered; a version covers a run of them, taken apart into nodes of a tree, and each number
    takes the least of the few nodes above it. So the work is the number of versions times the height of the tree, also
    where all of them name one key.
    """
    points = versions.select(key, F.col("valid_from").alias("at")).union(versions.filter("valid_to IS NOT NULL").select(key, "valid_to")).distinct()
    order = Window.partitionBy(key).orderBy("at")
    numbered = stored(
        points.select(key, F.col("at").alias("lo"), F.lead("at").over(order).alias("hi"), (F.row_number().over(order) - 1).cast("long").alias("leaf")),
        "rule-changes",
    )
    most = numbered.agg(F.max("leaf").alias("n")).first().n
    if most is None:
        return versions.select(key, F.col("valid_from").alias("lo"), F.col("valid_to").alias("hi"), "hit")
    levels = levels_for(most + 2)
    begin, end = numbered.select(key, F.col("lo").alias("valid_from"), F.col("leaf").alias("_i")), numbered.select(
        key, F.col("lo").alias("valid_to"), F.col("leaf").alias("_j")
    )
    covered = versions.join(begin, [key, "valid_from"]).join(end, [key, "valid_to"], "left").withColumn(
        "_j", F.coalesce("_j", F.lit(most + 1))
    )
    nodes = covered.select(key, "hit", F.inline(tree_nodes("_i", "_j", levels))).groupBy(key, "level", "node").agg(F.min("hit").alias("hit"))
    above = F.expr(f"transform(sequence(0, {levels - 1}), l -> named_struct('level', l, 'node', CAST(leaf div CAST(pow({FAN}, l) AS BIGINT) AS BIGINT)))")
    found = numbered.select(key, "lo", "hi", F.inline(above)).join(nodes, [key, "level", "node"]).groupBy(key, "lo", "hi").agg(F.min("hit").alias("hit"))
    return found

"""Running totals and exact quantiles over a whole table, without putting it in order in one task.

Values are cut into buckets of like size at approximate quantiles; a window orders each bucket, and the totals of
the buckets before it are added. Where the cuts fall only affects balance, never the result, but they must be the
same in every branch and every retry of the plan, so they are computed once and written into the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskengine.session import stored

ROWS_PER_BUCKET = 1_000_000
FEW_BUCKETS, MAX_BUCKETS = 128, 4096
MD5_DIGITS = 3


def _cuts(df: DataFrame, value: str, rows_per_bucket: int) -> list[float]:
    """Approximate quantiles that cut the values into buckets of about ``rows_per_bucket``."""
    number = F.col(value).cast("double")
    steps = [i / FEW_BUCKETS for i in range(1, FEW_BUCKETS)]
    # The size and a first set of cuts in one pass; more cuts only for data that needs them.
    seen = df.agg(F.count(value).alias("n"), F.percentile_approx(number, steps, 10 * FEW_BUCKETS).alias("cuts")).first()
    buckets = min(MAX_BUCKETS, -(-seen.n // rows_per_bucket))
    if buckets <= 1:
        return []
    if buckets <= FEW_BUCKETS:
        return sorted(set(seen.cuts[:: FEW_BUCKETS // buckets]))
    steps = [i / buckets for i in range(1, buckets)]
    return sorted(set(df.agg(F.percentile_approx(number, steps, 10 * buckets).alias("cuts")).first().cuts))


def with_buckets(df: DataFrame, value: str, cuts: list[float]) -> DataFrame:
    """Adds ``_bucket``, which grows with ``value`` and is equal for equal values."""
    splits = [float("-inf"), *cuts, float("inf")]
    numbered = df.withColumn("_double", F.col(value).cast("double"))
    # NaN sorts last in Spark and goes to a bucket after all others. So does null, which sorts first: it gets -1.
    bucketizer = Bucketizer(splits=splits, inputCol="_double", outputCol="_bucket", handleInvalid="keep")
    bucket = F.when(F.col(value).isNull(), F.lit(-1.0)).otherwise(F.col("_bucket"))
    return bucketizer.transform(numbered).withColumn("_bucket", bucket).drop("_double")


def _join_null_safe(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An inner join by ``keys`` in which null meets null."""
    other = other.withColumnsRenamed({k: f"_o_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys])
    return df.join(other, same).drop(*[f"_o_{k}" for k in keys])


def prefix_sums(
    df: DataFrame,
    value: str,
    measures: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """For rows unique in (groups, value): adds ``{m}_before``, the total of the rows that precede in ``value``
    order within the group, and ``{m}_total``, the total of the group."""
    order = F.col(value).desc() if descending else F.col(value).asc()

    def running(window, m):
        return F.coalesce(F.sum(m).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    whole = Window.partitionBy(*groups)
    cuts = _cuts(df, value, rows_per_bucket)
    if not cuts:
        # No more rows than fit one bucket.
        ordered = whole.orderBy(order)
        before = [running(ordered, m).alias(f"{m}_before") for m in measures]
        return df.select("*", *before, *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures])

    keys, columns = [*groups, "_bucket"], df.columns
    df = with_buckets(df, value, cuts)
    # One row per bucket here: at most MAX_BUCKETS per group.
    earlier = whole.orderBy(F.col("_bucket").desc() if descending else F.col("_bucket").asc())
    offsets = df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]).select(
        *keys,
        *[running(earlier, m).alias(f"_{m}_offset") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
    )
    local = Window.partitionBy(*keys).orderBy(order)
    met = _join_null_safe(df, offsets, keys)
    before = [(running(local, m) + F.col(f"_{m}_offset")).alias(f"{m}_before") for m in measures]
    return met.select(*columns, *before, *[f"{m}_total" for m in measures])


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    groups: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Interpolated quantiles per group, one column per name. Equal values are counted before the shuffle, and the counts
    written once, so that the input is read once however many cuts and offsets are taken."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*groups, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("n"))
    return quantiles_of_counts(stored(counts, "value-counts"), probabilities, groups, rows_per_bucket)


def quantiles_of_counts(
    counts: DataFrame, probabilities: dict[str, float], groups: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """The same of values ``_v`` that are already counted (``n``)."""
    ranked = prefix_sums(counts, "_v", ["n"], groups, rows_per_bucket=rows_per_bucket)
    first, end = F.col("n_before"), F.col("n_before") + F.col("n")

    picks = []
    for i, p in enumerate(probabilities.values()):
        at = F.lit(p) * (F.col("n_total") - 1)
        low = F.floor(at)
        # floor + 1 is past the end only where it weighs nothing.
        high = F.least(low + 1, F.col("n_total") - 1)
        picks += [
            F.max(F.when((first <= low) & (low < end), F.col("_v"))).alias(f"_low{i}"),
            F.max(F.when((first <= high) & (high < end), F.col("_v"))).alias(f"_high{i}"),
            F.max(at - low).alias(f"_part{i}"),
        ]
    found = ranked.groupBy(*groups).agg(*picks)
    return found.select(
        *groups,
        *[
            (F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * F.col(f"_part{i}")).alias(name)
            for i, name in enumerate(probabilities)
        ],
    )


def hashed_rank(df: DataFrame, groups: Sequence[str], key: str, seed: str = "", measures: Sequence[str] = ()) -> DataFrame:
    """Numbers the rows of each group, from 1, in the order of ``md5(seed || key)``: adds ``rank``, ``group_size``
    and a running ``{m}_upto`` for each measure.

    The order looks random and is the same on every run. A group is worked on in 4096 parts by leading hex digits,
    so a group that is most of the table is still spread out.
    """
    df = df.withColumn("_hash", F.md5(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))))).withColumn(
        "_part", F.substring("_hash", 1, MD5_DIGITS)
    )
    df = df.withColumn("_one", F.lit(1).cast("long"))
    keys, sums = [*groups, "_part"], ["_one", *measures]
    local = Window.partitionBy(*keys).orderBy("_hash", key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in sums]).select(
        *keys,
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_off_{m}") for m in sums],
        F.sum("_one").over(Window.partitionBy(*groups)).alias("group_size"),
    )
    out = _join_null_safe(df, offsets, keys)
    out = out.withColumn("rank", F.sum("_one").over(local) + F.col("_off__one"))
    for m in measures:
        out = out.withColumn(f"{m}_upto", F.sum(m).over(local) + F.col(f"_off_{m}"))
    return out.drop("_hash", "_part", "_one", *[f"_off_{m}" for m in sums])

"""Joins that hold when one key carries much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32
#: What may be broadcast: so many rows, and so many bytes of their values written out.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether the rows are few and small enough; no more of them are looked at than would be."""
    written = F.octet_length(F.to_json(F.struct(*df.columns)))
    seen = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(written), F.lit(0)).alias("bytes")).first()
    return seen.n <= rows and seen.bytes <= size


def spread(keyed: DataFrame, salts: int = SALTS) -> DataFrame:
    """``keyed`` repeated in each of ``salts`` places. Spark sizes it by its files, before the repeat, and would broadcast
    what is too large to; it is joined by a shuffle instead."""
    return keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")


def salted_join(big: DataFrame, keyed: DataFrame, on: str, how: str, spread_by: str, salts: int = SALTS) -> DataFrame:
    """Equi-join whose big side may be lopsided in ``on``; ``keyed`` has one row per key.

    Each key's rows go to ``salts`` places by the hash of ``spread_by``, and the keyed side is repeated in each.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    return left.join(spread(keyed, salts), [on, "_salt"], how).drop("_salt")


def lookup_join(
    big: DataFrame, keyed: DataFrame, on: str, how: str, spread_by: str, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Join with a cheap lookup table, one row per key: broadcast if it is seen to be small, salted if not."""
    if fits_broadcast(keyed, limit):
        return big.join(F.broadcast(keyed), on, how)
    return salted_join(big, keyed, on, how, spread_by)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    start: str,
    end: str,
    bucket_us: int,
    spread_by: str,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of ``points`` with each interval that holds them, ``start <= at < end``; all are timestamps.

    Intervals are repeated in the time buckets they touch, so this is an equi-join by bucket with the exact bounds tested;
    the intervals are broadcast if they are small in rows and bytes, else points and intervals are spread.
    """
    touched = F.sequence(F.floor(F.unix_micros(start) / bucket_us), F.floor((F.unix_micros(end) - 1) / bucket_us))
    right = intervals.filter(F.col(start) < F.col(end)).select("*", F.explode(touched).alias("_bucket"))
    left, keys = points.withColumn("_bucket", F.floor(F.unix_micros(at) / bucket_us)), ["_bucket"]
    if fits_broadcast(right, limit):
        right = F.broadcast(right)
    else:
        left = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
        right = spread(right)
        keys.append("_salt")
    left, right = left.alias("p"), right.alias("i")
    inside = (F.col(f"p.{at}") >= F.col(f"i.{start}")) & (F.col(f"p.{at}") < F.col(f"i.{end}"))
    for k in keys:
        inside = inside & (F.col(f"p.{k}") == F.col(f"i.{k}"))
    return left.join(right, inside).select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"i.{c}") for c in intervals.columns])


def members(df: DataFrame, keys: DataFrame, on: str, spread_by: str) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return salted_join(df, keys.select(on).distinct(), on, "left_semi", spread_by)


def first_value_by(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """The value of each key's first row, as an aggregate that shrinks before the shuffle."""
    return df.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(f"first_{value}"))

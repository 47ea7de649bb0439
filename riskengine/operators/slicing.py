"""Cutting an account's history into time slices that can be worked on alone.

A window partitioned by account puts all of an account into one task. Here the partition is (account, slice):
each row lives in the slice its time falls in, and is repeated as a *halo* row in the later slices whose rows
may still look back at it. The extra volume is lookback / slice width; the largest group is one account's rows in
one slice plus its lookback, however large the account is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.functions.time import bucket
from riskengine.operators.joins import lookup_join
from riskengine.session import shared_dir

SLICE, OWN, WIDTH = "_slice", "_own", "_width"
#: Unless told otherwise, accounts whose slices hold more rows than this are cut finer.
ROWS_PER_SLICE = 1_000_000


def with_widths(df: DataFrame, time: str, width: int, least: int, rows_per_slice: int | None) -> DataFrame:
    """Adds ``_width``, the slice width of the row's account.

    One pass counts rows per account and slice, and accounts with more than ``rows_per_slice`` in one are cut finer, down
    to ``least``; ``None`` leaves the pass out. There are no more such accounts than the table holds multiples of that number.
    """
    if rows_per_slice is None:
        return df.withColumn(WIDTH, F.lit(width).cast("long"))
    path = shared_dir(df.sparkSession, "widths")
    counts = df.groupBy("account_id", bucket(time, width).alias(SLICE)).agg(F.count(F.lit(1)).alias("n"))
    fit = F.greatest(F.lit(least), F.floor(F.lit(float(width) * rows_per_slice) / F.max("n"))).cast("long")
    counts.filter(F.col("n") > rows_per_slice).groupBy("account_id").agg(fit.alias("_finer")).write.parquet(path)
    finer = df.sparkSession.read.parquet(path)
    if not finer.limit(1).count():
        return df.withColumn(WIDTH, F.lit(width).cast("long"))
    joined = lookup_join(df, finer, "account_id", "left", "transaction_id")
    return joined.select(*df.columns, F.coalesce("_finer", F.lit(width)).cast("long").alias(WIDTH))


def halo_slices(df: DataFrame, time: str, lookback: int) -> DataFrame:
    """Adds ``_slice`` and ``_own``; a row comes out once with ``_own`` true and once per later slice it reaches.

    ``time`` is an integer column; ``_width`` and ``lookback`` are in its unit.
    """
    home, reach = bucket(time, WIDTH), bucket(f"{time} + {lookback}L", WIDTH)
    cut = df.select("*", F.explode(F.sequence(home, reach)).alias(SLICE))
    return cut.withColumn(OWN, F.col(SLICE) == home)

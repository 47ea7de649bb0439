"""Event-time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS, US = "ms", "us"
PER_SECOND = {MS: 1_000, US: 1_000_000}


def epoch(col: str | Column, unit: str = MS) -> Column:
    """Integer event time; windows are inclusive to this resolution."""
    return F.unix_millis(col) if unit == MS else F.unix_micros(col)


def bucket(time: str, width: int | str) -> Column:
    """Floor division of an integer time (a column or an expression), right for times before 1970 too.

    ``width`` is a number or the name of a column.
    """
    w = f"{width}L" if isinstance(width, int) else f"`{width}`"
    return F.expr(f"(({time}) - pmod({time}, {w})) div {w}")


def latency_ms() -> Column:
    return F.unix_millis("decided_at") - F.unix_millis("produced_at")


def with_latency(df):
    return df.withColumn("latency_ms", latency_ms())


def time_range(df, col: str, start=None, end=None):
    """Rows with ``start <= col < end``; a plain comparison, so it reaches the scan."""
    if start is not None:
        df = df.filter(F.col(col) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(col) < F.lit(end))
    return df

"""Rolling behavioural features per account, for training, serving and replay.

What a row finds in its window is a running total over *events*: each row adds itself when it comes and, per window
length, takes itself out again when it leaves. Rows and leavings are sorted together once, so the cost of a row does
not depend on how full its windows are, while a sliding frame would be summed again for every row. History is cut
into (account, slice) groups with a halo as long as the longest window, and what lies further back (the previous
row's time, the home location) comes in as one *carry* row per group. With ``rows_per_slice``, busy accounts are cut
finer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.constants import FEATURES
from riskengine.functions.predicates import is_domestic, is_home, log_amount_ratio
from riskengine.functions.time import MS, PER_SECOND, US, bucket, epoch
from riskengine.operators.slicing import OWN, ROWS_PER_SLICE, SLICE, WIDTH, halo_slices, with_widths

HOUR_S = 3600
DAY_S = 24 * HOUR_S
SLICE_S = 7 * DAY_S
#: Input rows per partition of the windows' exchange, whose sort holds a task's whole share.
ROWS_PER_TASK = 50_000

# Where a carry row stands: before all times.
_BEFORE_ALL = -(2**62)


@dataclass(frozen=True)
class Rolling:
    """What a mode counts as history.

    ``unit``: resolution of time. ``ties_count``: are earlier arrivals with the same time part of the window?
    ``gap_limit_s``: how far back the previous row may be. ``with_home``: derive the home location?
    """

    unit: str
    ties_count: bool
    gap_limit_s: int | None
    with_home: bool


TRAINING = Rolling(US, ties_count=False, gap_limit_s=None, with_home=False)
SERVING = Rolling(MS, ties_count=True, gap_limit_s=DAY_S, with_home=True)
REPLAY = Rolling(US, ties_count=True, gap_limit_s=None, with_home=True)


def _carry(df: DataFrame, with_home: bool) -> DataFrame:
    """Per (account, slice): the last time before the slice and the account's first location.

    The aggregate shrinks before its shuffle; the window then sees one row per slice of an account.
    """
    where = F.min_by("location_name", F.struct("_k", "transaction_id")) if with_home else F.lit(None).cast("string")
    per_slice = df.groupBy("account_id", bucket("_k", WIDTH).alias(SLICE)).agg(
        F.max("_k").alias("_last"), where.alias("_where")
    )
    w = Window.partitionBy("account_id").orderBy(SLICE)
    return per_slice.select(
        "account_id",
        SLICE,
        F.lag("_last").over(w).alias("_before"),
        F.first("_where").over(w).alias("_home"),
        F.lit(False).alias(OWN),
    )


def rolling(
    df: DataFrame,
    mode: Rolling,
    include: Column | None = None,
    slice_s: int = SLICE_S,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Adds ``_n1``, ``_n3`` (rows in 1 h and 3 h), ``_n24``, ``_sum24`` (included rows in 24 h and their amount),
    ``_gap`` (time since the previous row, null if none), ``_home`` and ``_first`` (no earlier row at all)."""
    per_s = PER_SECOND[mode.unit]
    hour, day = HOUR_S * per_s, DAY_S * per_s
    payload = df.columns
    counts = F.lit(True) if include is None else F.coalesce(include, F.lit(False))
    timed = df.withColumns({"_k": epoch("event_time", mode.unit), "_inc": counts.cast("int")})
    timed = with_widths(timed, "_k", slice_s * per_s, day, rows_per_slice)
    groups, carry = halo_slices(timed, "_k", day), _carry(timed, mode.with_home)
    # The sort before the windows holds a task's whole share: with a fixed number of partitions that share, and a
    # task's memory, grew with the input. So many partitions now that a share stays near ROWS_PER_TASK input rows.
    spark = df.sparkSession
    least = spark.conf.get("spark.sql.shuffle.partitions")
    parts = max(int(least) if least.isdigit() else 1, -(-df.count() // ROWS_PER_TASK))
    groups = groups.unionByName(carry, allowMissingColumns=True).repartition(parts, "account_id", SLICE)

    # After the exchange a row becomes its arrival and its leavings; the payload stays with the arrival.
    def event(offset: int, d1: int, d3: int, d24: int) -> str:
        values = f"_k + {offset}L AS at, {d1} AS d1, {d3} AS d3, {d24} * _inc AS d24, {d24} * _inc * amount AS sum24"
        return "struct(" + values + f", {offset > 0} AS leaves)"

    events = (event(0, 1, 1, 1), event(hour, -1, 0, 0), event(3 * hour, 0, -1, 0), event(day, 0, 0, -1))
    nothing = f"struct({_BEFORE_ALL}L AS at, 0 AS d1, 0 AS d3, 0 AS d24, 0L * amount AS sum24, false AS leaves)"
    flat = groups.select(
        "account_id",
        SLICE,
        F.col("transaction_id").alias("_id"),
        F.col("_k").alias("_time"),
        "_before",
        F.col("_home").alias("_carried_home"),
        *[F.col(c).alias(f"_p_{c}") for c in payload],
        OWN,
        WIDTH,
        F.expr(f"inline(CASE WHEN _k IS NULL THEN array({nothing}) ELSE array({', '.join(events)}) END)"),
    )
    # What leaves after the end of the slice is of no concern there; a carry row has no width.
    flat = flat.filter(F.col(WIDTH).isNull() | (F.col("at") < (F.col(SLICE) + 1) * F.col(WIDTH)))
    arrival = ~F.col("leaves")
    row = F.when(F.col(OWN) & arrival, F.struct(*[F.col(f"_p_{c}").alias(c) for c in payload]))
    flat = flat.select(
        "account_id", SLICE, "_id", "_time", "_before", "_carried_home", row.alias("_row"), "at", "d1", "d3", "d24",
        "sum24", "leaves",
    )

    # A leaving at t - w is still inside the window that starts there, so it comes after the rows of its time.
    order = Window.partitionBy("account_id", SLICE).orderBy("at", "leaves", "_id")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    if mode.ties_count:
        counted = before
    else:
        counted = Window.partitionBy("account_id", SLICE).orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    found = flat.select(
        "_row",
        "_time",
        *[
            F.coalesce(F.sum(c).over(counted), F.lit(0)).alias(name)
            for c, name in (("d1", "_n1"), ("d3", "_n3"), ("d24", "_n24"), ("sum24", "_sum24"))
        ],
        F.last(F.when(arrival, F.col("_time")), ignorenulls=True).over(before).alias("_prev"),
        F.last("_before", ignorenulls=True).over(upto).alias("_prev_carried"),
        F.last("_carried_home", ignorenulls=True).over(upto).alias("_home"),
    ).filter(F.col("_row").isNotNull())
    previous = F.coalesce("_prev", "_prev_carried")
    gap = F.col("_time") - previous
    if mode.gap_limit_s is not None:
        gap = F.when(gap <= mode.gap_limit_s * per_s, gap)
    return found.select(
        "_row.*", "_n1", "_n3", "_n24", "_sum24", gap.alias("_gap"), "_home", previous.isNull().alias("_first")
    )


def _avg24(amount: Column) -> Column:
    return F.when(F.col("_n24") > 0, F.col("_sum24").cast("double") / F.col("_n24")).otherwise(amount.cast("double"))


def _finish(df: DataFrame, keep: Sequence[str], columns: dict[str, Column], float32: bool) -> DataFrame:
    if float32:
        columns = {name: c.cast("float").cast("double") for name, c in columns.items()}
    return df.select(*[c for c in keep if c not in columns], *[c.alias(name) for name, c in columns.items()])


def _columns(mode: Rolling, home: Column, domestic: Column) -> dict[str, Column]:
    amount = F.col("amount").cast("double")
    average = _avg24(F.col("amount"))
    values = (
        amount,
        F.hour("event_time").cast("double"),
        home.cast("int").cast("double"),
        domestic.cast("int").cast("double"),
        average,
        log_amount_ratio(amount, average),
        F.col("_n1").cast("double"),
        F.col("_n3").cast("double"),
        F.coalesce(F.col("_gap") / PER_SECOND[mode.unit], F.lit(0.0)),
    )
    return dict(zip(FEATURES, values))


def training_features(
    df: DataFrame, slice_s: int = SLICE_S, float32: bool = False, rows_per_slice: int | None = ROWS_PER_SLICE
) -> DataFrame:
    """From a labelled set with its own is_home and is_domestic: windows [t - w, t), all history averaged."""
    columns = _columns(TRAINING, F.col("is_home"), F.col("is_domestic"))
    return _finish(rolling(df, TRAINING, None, slice_s, rows_per_slice), df.columns, columns, float32)


def serving_features(
    df: DataFrame,
    include: Column | None = None,
    slice_s: int = SLICE_S,
    float32: bool = False,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """As the decision path sees them: windows [t - w, t], only rows with ``include`` averaged.

    By default these are the approved rows of a decided log.
    """
    include = F.col("decision") == "APPROVED" if include is None else include
    location = F.col("location_name")
    home = is_home(F.when(~F.col("_first"), F.col("_home")), location)
    columns = _columns(SERVING, home, is_domestic(location))
    return _finish(rolling(df, SERVING, include, slice_s, rows_per_slice), df.columns, columns, float32)


def replay_features(df: DataFrame, slice_s: int = SLICE_S, rows_per_slice: int | None = ROWS_PER_SLICE) -> DataFrame:
    """As the model validation replays them: all history averaged, figures rounded."""
    location = F.col("location_name")
    columns = _columns(REPLAY, F.coalesce(F.col("_home") == location, F.lit(False)), is_domestic(location))
    # The mean is rounded as the fraction it is: halves go up whatever its nearest double.
    cents = F.expr("(200 * _sum24 + _n24) div (2 * _n24)") / 100.0
    columns["avg_amount_24h"] = F.when(F.col("_n24") > 0, cents).otherwise(F.col("amount").cast("double"))
    columns["log_amount_ratio_24h"] = F.round(columns["log_amount_ratio_24h"], 6)
    columns["time_since_last_tx_sec"] = F.round(columns["time_since_last_tx_sec"], 1)
    return _finish(rolling(df, REPLAY, None, slice_s, rows_per_slice), df.columns, columns, False)

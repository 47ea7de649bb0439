"""Serving features when the score itself decides what later averages include.

The mean of the last day counts only approved rows, and whether a row is approved depends on its own mean, so an
account's rows are a chain. What does not depend on decisions is found once for all rows in the usual way. The chain is
cut into (account, time slice) groups that are solved side by side. A group is handed, from the slices before it, the sum
and number of approved rows that stay in the window throughout, and one by one those that leave it during the slice. The
first round takes every row of the model as approved; where that turns out wrong, only the groups that were handed it
are solved again. An account's n-th slice is right after n rounds, so there are no more rounds than slices, and mostly
two or three. Busy accounts have narrower slices, far below the day they look back, so a group is bounded whatever an
account holds.

Within a task the groups advance together: all undecided rows are scored under a guess, every group is settled up to and
with the first row whose guess was wrong, and only a short stretch behind it is scored again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.constants import FEATURES, SCORE_THRESHOLD
from riskengine.functions.time import bucket
from riskengine.operators.features import DAY_S, SLICE_S, serving_features
from riskengine.operators.slicing import ROWS_PER_SLICE, SLICE, WIDTH, with_widths
from riskengine.session import shared_dir

#: From rows by nine features, in the order of ``FEATURES``, to their scores. Runs in tasks, on any rows together.
Scorer = Callable[[np.ndarray], np.ndarray]

DAY_MS = DAY_S * 1000
#: The narrowest slice of a busy account.
LEAST_SLICE_MS = 15 * 60 * 1000
CHUNK_ROWS = 100_000
_LEAST_STRETCH, _STRETCH, _MOST_STRETCH = 32, 256, 1 << 16
_CARRY, _LEAVING, _OWN = 0, 1, 2
_GIVEN = tuple(f for f in FEATURES if f not in ("avg_amount_24h", "log_amount_ratio_24h"))
_PLACE = {f: i for i, f in enumerate(FEATURES)}
_STATE = (
    f"account_id string, {SLICE} bigint, {WIDTH} bigint, _ms bigint, transaction_id string, _row bigint, _money bigint, "
    "_status int, " + ", ".join(f"{f} double" for f in _GIVEN) + ", avg_amount_24h double, log_amount_ratio_24h double, "
    "ml_score double, _approved boolean, _changed boolean"
)


def _settle(base_sum, base_count, lo, starts, money, status, given, score, threshold):
    """Decides rows that are sorted by group and time; ``lo`` is the first row of a row's window within its group and
    ``starts`` where groups begin. Returns means, ratios, scores and approvals."""
    n = len(money)
    approved = np.where(status < 0, True, status > 0)
    sums, counts = np.zeros(n, np.int64), np.zeros(n, np.int64)  # of approved rows of the group before each row
    means, ratios, scores = np.zeros(n), np.zeros(n), np.full(n, np.nan)
    amount = given[:, 0]
    front, ends = starts.copy(), np.append(starts[1:], n)
    stretch = ends - front
    open_groups = np.flatnonzero(front < ends)
    while len(open_groups):
        first = front[open_groups]
        length = np.minimum(stretch[open_groups], ends[open_groups] - first)
        heads = np.cumsum(length) - length
        rows = np.repeat(first - heads, length) + np.arange(int(length.sum()))
        # Totals before each row go on from those at the group's first undecided row.
        for total, each in ((sums, approved[rows] * money[rows]), (counts, approved[rows].astype(np.int64))):
            running = np.cumsum(each) - each
            total[rows] = running + np.repeat(total[first] - running[heads], length)
        number = base_count[rows] + counts[rows] - counts[lo[rows]]
        whole = (base_sum[rows] + sums[rows] - sums[lo[rows]]).astype(np.float64)
        mean = np.where(number > 0, whole / np.maximum(number, 1), amount[rows])
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(mean > 0, np.log1p(amount[rows] / mean), np.log1p(1.0))
        judged = status[rows] < 0
        matrix = np.empty((int(judged.sum()), len(FEATURES)))
        for i, name in enumerate(_GIVEN):
            matrix[:, _PLACE[name]] = given[rows[judged], i]
        matrix[:, _PLACE["avg_amount_24h"]], matrix[:, _PLACE["log_amount_ratio_24h"]] = mean[judged], ratio[judged]
        found = np.full(len(rows), np.nan)
        if len(matrix):
            found[judged] = score(matrix)
        passed = np.where(judged, found < threshold, approved[rows])
        wrong = np.flatnonzero(passed != approved[rows])
        means[rows], ratios[rows], scores[rows], approved[rows] = mean, ratio, found, passed
        # Up to and with its first wrong guess a group is settled.
        at = np.searchsorted(wrong, heads)
        following = np.append(wrong, len(rows))[at]
        settled = np.minimum(following - heads + 1, length)
        front[open_groups] = first + settled
        next_stretch = np.where(settled < length, np.maximum(_LEAST_STRETCH, 2 * settled), 2 * np.maximum(length, _STRETCH))
        stretch[open_groups] = np.minimum(next_stretch, _MOST_STRETCH)
        # Where guesses went wrong, totals behind are taken up from the last settled row.
        going = open_groups[front[open_groups] < ends[open_groups]]
        last = front[going] - 1
        sums[front[going]] = sums[last] + approved[last] * money[last]
        counts[front[going]] = counts[last] + approved[last]
        open_groups = going
    return means, ratios, scores, approved


def _solve(table: pa.Table, edges: np.ndarray, score: Scorer, threshold: float) -> pa.RecordBatch:
    """Solves whole groups, which begin at ``edges``. Rows come by group, kind, time and id."""
    number = lambda c: table.column(c).to_numpy()
    kind, at, money, count = number("_kind"), number("_ms"), number("_money"), number("_count")
    group = np.zeros(len(kind), np.int64)
    group[edges[1:]] = 1
    group = np.cumsum(group)
    span = int(at.max() - at.min()) + DAY_MS + 2
    if (group[-1] + 1) * span >= 2**62 and len(edges) > 1:
        middle = len(edges) // 2
        cut = int(edges[middle])
        halves = (_solve(table.slice(0, cut), edges[:middle], score, threshold), _solve(table.slice(cut), edges[middle:] - cut, score, threshold))
        return pa.Table.from_batches(halves).combine_chunks().to_batches()[0]
    key = group * span + (at - at.min())
    own, leaving, carry = (np.flatnonzero(kind == k) for k in (_OWN, _LEAVING, _CARRY))
    g, own_key = group[own], key[own]
    lo = np.searchsorted(own_key, own_key - DAY_MS, "left")
    # What leaves before a row's time no longer counts; what leaves at that very time does.
    gone, end = np.searchsorted(key[leaving], own_key, "left"), np.searchsorted(key[leaving], (g + 1) * span, "left")
    base = []
    for values in (money, count):
        total = np.zeros(int(group[-1]) + 1, np.int64)
        np.add.at(total, group[carry], values[carry])
        upto = np.concatenate([[0], np.cumsum(values[leaving])])
        base.append(total[g] + upto[end] - upto[gone])
    rows = table.take(pa.array(own))
    starts = np.flatnonzero(np.diff(g, prepend=-1))
    given = np.column_stack([rows.column(f).to_numpy() for f in _GIVEN])
    status = rows.column("_status").to_numpy()
    mean, ratio, found, approved = _settle(*base, lo, starts, money[own], status, given, score, threshold)
    before = rows.column("_approved").to_numpy(zero_copy_only=False).astype(bool)
    new = {
        "avg_amount_24h": pa.array(mean), "log_amount_ratio_24h": pa.array(ratio), "ml_score": pa.array(found, from_pandas=True),
        "_approved": pa.array(approved), "_changed": pa.array(approved != before),
    }
    names = [c.split()[0] for c in _STATE.split(", ")]
    columns = [new[c] if c in new else rows.column(c).combine_chunks() for c in names]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _edges(table: pa.Table) -> np.ndarray:
    """Where the groups begin."""
    new = np.ones(table.num_rows, bool)
    differs = np.zeros(table.num_rows - 1, bool)
    for name in ("account_id", SLICE):
        column = table.column(name).combine_chunks()
        a, b = column.slice(1), column.slice(0, len(column) - 1)
        unequal = pc.fill_null(pc.not_equal(a, b), pc.not_equal(pc.is_null(a), pc.is_null(b)))
        differs |= unequal.to_numpy(zero_copy_only=False)
    new[1:] = differs
    return np.flatnonzero(new)


def _in_groups(score: Scorer, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        held, rows, enough = [], 0, CHUNK_ROWS
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < enough:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            edges = _edges(table)
            if len(edges) > 1:
                # The last group may go on in the next batch.
                yield _solve(table.slice(0, int(edges[-1])), edges[:-1], score, threshold)
                table = table.slice(int(edges[-1]))
            held, rows = table.to_batches(), table.num_rows
            enough = max(CHUNK_ROWS, 2 * rows)
        if rows:
            table = pa.Table.from_batches(held).combine_chunks()
            yield _solve(table, _edges(table), score, threshold)

    return run


def _handed(rows: DataFrame) -> DataFrame:
    """What approved rows are to later slices of their account: part of a carried total as long as they stay in the
    window, and one event in the slice in which they leave it."""
    out = bucket(f"_ms + {DAY_MS}L", WIDTH)
    own = rows.filter("_approved").select("account_id", SLICE, WIDTH, "_ms", "_money").withColumn("_out", out)
    leaving = own.filter(F.col("_out") > F.col(SLICE)).select(
        "account_id", F.col("_out").alias(SLICE), F.lit(_LEAVING).alias("_kind"), (F.col("_ms") + DAY_MS).alias("_ms"), "_money",
        F.lit(1).cast("long").alias("_count"),
    )
    staying = own.filter(F.col("_out") > F.col(SLICE) + 1).groupBy("account_id", SLICE, "_out").agg(
        F.sum("_money").alias("_money"), F.count(F.lit(1)).alias("_count"), F.min("_ms").alias("_ms")
    )
    later = F.explode(F.sequence(F.col(SLICE) + 1, F.col("_out") - 1))
    carried = staying.select("account_id", later.alias(SLICE), "_ms", "_money", "_count").groupBy("account_id", SLICE).agg(
        F.min("_ms").alias("_ms"), F.sum("_money").alias("_money"), F.sum("_count").alias("_count")
    )
    return leaving.unionByName(carried.withColumn("_kind", F.lit(_CARRY)).select(leaving.columns))


def _only(df: DataFrame, groups: DataFrame | None) -> DataFrame:
    if groups is None:
        return df
    same = F.col("a.account_id").eqNullSafe(F.col("b.account_id")) & (F.col(f"a.{SLICE}") == F.col(f"b.{SLICE}"))
    return df.alias("a").join(groups.alias("b"), same, "left_semi")


def serve_in_order(
    staged: DataFrame,
    score: Scorer,
    threshold: float = SCORE_THRESHOLD,
    slice_s: int = SLICE_S,
    rows_per_slice: int | None = ROWS_PER_SLICE,
    known: Column | None = None,
    amend: Callable[[DataFrame], DataFrame] | None = None,
    log: list[int] | None = None,
) -> DataFrame:
    """Adds the nine features, ``ml_score`` and ``approved`` to rows with a ``stage``.

    Rows of the model stage are approved if ``score`` is below the threshold, allow-listed rows always, all others never;
    a row with a non-null ``known`` is settled already, in that way. ``amend`` may correct features that do not depend on
    decisions, and add columns. Every round is a written table in the shared folder, so a lost executor costs only its own tasks. ``log``
    receives the number of groups solved in each round.
    """
    spark = staged.sparkSession
    root = shared_dir(spark, "feedback")
    known = F.lit(None).cast("boolean") if known is None else known
    fixed = F.when(known.isNotNull(), known.cast("int")).when(F.col("stage") == "ML", -1).otherwise((F.col("stage") == "PRIORITY").cast("int"))
    marked = staged.withColumns({"_status": fixed, "_money": F.col("amount").cast("long"), "_ms": F.unix_millis("event_time")})
    featured = serving_features(marked, F.lit(False), slice_s, rows_per_slice=rows_per_slice)
    if amend is not None:
        featured = amend(featured)
    # The numbers are written with the rows, so all that follows sees the same.
    featured.withColumn("_row", F.monotonically_increasing_id()).write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")

    narrow = rows.select("account_id", "_ms", "transaction_id", "_row", "_money", "_status", *_GIVEN)
    narrow = with_widths(narrow, "_ms", slice_s * 1000, min(LEAST_SLICE_MS, slice_s * 1000), rows_per_slice)
    nothing = {c: F.lit(None).cast("double") for c in ("avg_amount_24h", "log_amount_ratio_24h", "ml_score")}
    latest = narrow.withColumn(SLICE, bucket("_ms", WIDTH)).withColumns({**nothing, "_approved": F.col("_status") != 0})
    groups, solved, rounds = None, [], 0
    while True:
        own = _only(latest, groups).withColumns({"_kind": F.lit(_OWN), "_count": F.lit(1).cast("long")}).drop("_changed", "_round")
        handed = _only(_handed(latest), groups)
        both = own.unionByName(handed, allowMissingColumns=True).repartition("account_id", SLICE)
        both = both.sortWithinPartitions("account_id", SLICE, "_kind", "_ms", "transaction_id", "_row")
        both.mapInArrow(_in_groups(score, threshold), _STATE).write.parquet(f"{root}/state/_round={rounds}")
        found = spark.read.parquet(f"{root}/state/_round={rounds}")
        if log is not None:
            log.append(found.select("account_id", SLICE).distinct().count())
        # Whoever was handed a row that came out otherwise is solved again.
        out = bucket(f"_ms + {DAY_MS}L", WIDTH)
        reached = found.filter("_changed").select("account_id", SLICE, out.alias("_out")).filter(F.col("_out") > F.col(SLICE)).distinct()
        reached = reached.select("account_id", F.explode(F.sequence(F.col(SLICE) + 1, "_out")).alias(SLICE)).distinct()
        rounds += 1
        # Only groups that have rows of their own.
        present = narrow.select("account_id", bucket("_ms", WIDTH).alias(SLICE)).distinct()
        _only(present, reached).write.parquet(f"{root}/again/_round={rounds}")
        groups = spark.read.parquet(f"{root}/again/_round={rounds}")
        solved.append(groups.withColumn("_last", F.lit(rounds)))
        if groups.isEmpty():
            break
        latest = _latest(spark.read.option("basePath", f"{root}/state").parquet(f"{root}/state"), solved[:-1])
    final = _latest(spark.read.option("basePath", f"{root}/state").parquet(f"{root}/state"), solved[:-1])
    answers = final.select("_row", "avg_amount_24h", "log_amount_ratio_24h", "ml_score", F.col("_approved").alias("approved"))
    out = rows.drop("avg_amount_24h", "log_amount_ratio_24h", "ml_score", "approved").join(answers, "_row")
    kept = [c for c in out.columns if c not in (*FEATURES, "ml_score", "approved", "_status", "_money", "_ms", "_row")]
    return out.select(*kept, *FEATURES, "ml_score", "approved")


def _latest(state: DataFrame, solved: list[DataFrame]) -> DataFrame:
    """Of each group the rows of its last round."""
    if not solved:
        return state
    newest = solved[0]
    for more in solved[1:]:
        newest = newest.unionByName(more)
    newest = newest.groupBy("account_id", SLICE).agg(F.max("_last").alias("_last"))
    same = F.col("a.account_id").eqNullSafe(F.col("b.account_id")) & (F.col(f"a.{SLICE}") == F.col(f"b.{SLICE}"))
    met = state.alias("a").join(newest.alias("b"), same, "left")
    return met.filter(F.col("_round") == F.coalesce("_last", F.lit(0))).select("a.*")

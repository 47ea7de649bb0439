import math
import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskengine.constants import DOMESTIC_LOCATIONS, FEATURES
from riskengine.operators import features

BASE = datetime(2026, 1, 1, tzinfo=timezone.utc)


def rows(seed, n=500, days=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        t = BASE + timedelta(seconds=rng.randrange(0, days * 86_400, 300))
        out.append((
            f"t{i:04d}", f"ACC_{min(rng.randrange(9), 3)}", rng.randrange(0, 5) * 1000, t,
            rng.choice(["Hanoi", "Hanoi", "Tokyo"]), rng.random() < 0.7, rng.random() < 0.5, rng.random() < 0.5,
        ))
    # An account that is silent for longer than any halo.
    for i, day in enumerate([0, 40, 41, 90]):
        out.append((f"q{i}", "ACC_Q", 700 + i, BASE + timedelta(days=day), ["Tokyo", "Hanoi"][i % 2], True, True, False))
    return out


def frame(spark, data):
    return spark.createDataFrame(
        data,
        "transaction_id string, account_id string, amount long, event_time timestamp, location_name string, "
        "ok boolean, is_home boolean, is_domestic boolean",
    )


def fold(data, mode):
    """One row at a time over each account's earlier rows."""
    out = {}
    for account in {r[1] for r in data}:
        history = []
        for r in sorted((r for r in data if r[1] == account), key=lambda r: (r[3], r[0])):
            tid, _, amount, t, loc, ok, home_flag, dom_flag = r
            back = lambda h: t - timedelta(hours=h)
            past = [h for h in history if h[3] < t] if mode == "training" else history
            avg = [h[2] for h in past if h[3] >= back(24) and (mode != "serving" or h[5])]
            average = sum(avg) / len(avg) if avg else float(amount)
            gap = (t - max(h[3] for h in history)).total_seconds() if history else 0.0
            if mode == "serving" and gap > 86_400:
                gap = 0.0
            domestic = loc in DOMESTIC_LOCATIONS
            if mode == "training":
                home, domestic = home_flag, dom_flag
            elif mode == "serving":
                home = history[0][4] == loc if history else domestic
            else:
                home = (history[0] if history else r)[4] == loc
            out[tid] = (
                float(amount), float(t.hour), float(home), float(domestic), average,
                math.log1p(amount / average if average > 0 else 1.0),
                float(sum(h[3] >= back(1) for h in past)), float(sum(h[3] >= back(3) for h in past)), gap,
            )
            history.append(r)
    return out


@pytest.mark.parametrize("mode", ["training", "serving", "replay"])
@pytest.mark.parametrize("slice_s,rows_per_slice", [(features.SLICE_S, None), (6 * 3600, None), (features.SLICE_S, 60)])
def test_features_equal_fold(spark, mode, slice_s, rows_per_slice):
    data = rows(7)
    df = frame(spark, data)
    if mode == "serving":
        got = features.serving_features(df, F.col("ok"), slice_s, rows_per_slice=rows_per_slice)
    elif mode == "training":
        got = features.training_features(df, slice_s, rows_per_slice=rows_per_slice)
    else:
        got = features.replay_features(df, slice_s, rows_per_slice)
    want = fold(data, mode)
    seen = got.collect()
    assert len(seen) == len(want)
    for r in seen:
        for name, value in zip(FEATURES, want[r.transaction_id]):
            assert r[name] == pytest.approx(value, abs=6e-3 if mode == "replay" else 1e-9), (r.transaction_id, name)


def test_features_shuffle_rows_once(spark):
    df = features.training_features(frame(spark, rows(1, 20)))
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # One for the rows, two for the carry table (per slice, then per account).
    assert plan.count("Exchange hashpartitioning") == 3


def test_float32_rounds_like_single_precision(spark):
    df = frame(spark, rows(2, 60))
    single = {r.transaction_id: r for r in features.training_features(df, float32=True).collect()}
    for r in features.training_features(df).collect():
        for name in FEATURES:
            assert single[r.transaction_id][name] == float(np.float32(r[name]))

import random
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from folds import cep_fold
from pyspark.sql import functions as F

from riskengine.operators import cep
from riskengine.operators.slicing import with_widths

BASE = datetime(2026, 1, 1, tzinfo=timezone.utc)
M = 1_000_000


def frame(spark, rows):
    """Rows of (account, amount, status, location, offset seconds)."""
    data = [
        (f"{a}-{i:04d}", a, int(amount), status, loc, BASE + timedelta(seconds=s))
        for i, (a, amount, status, loc, s) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data, "transaction_id string, account_id string, amount long, status string, location_name string, event_time timestamp"
    )


def same(amount, status, offsets, account="ACC1", loc="Hanoi"):
    return [(account, amount, status, loc, s) for s in offsets]


GOLDEN = [
    ("HIGH_FREQUENCY", same(120 * M, "Approved", [0, 60, 120]), [False, False, True]),
    ("HIGH_FREQUENCY", same(50 * M, "Approved", [0, 10, 20, 30, 40]), [False] * 5),
    ("HIGH_FREQUENCY", same(150 * M, "Declined", [0, 10, 20, 30, 40]), [False] * 5),
    ("HIGH_FREQUENCY", same(120 * M, "Approved", [0, 1900, 3700]), [False]),
    ("HIGH_FREQUENCY", same(120 * M, "Approved", [0, 10]) + same(120 * M, "Approved", [20], "ACC2"), [False]),
    ("LOCATION_JUMP", [("ACC1", 500_000, "Approved", "Hanoi", 0), ("ACC1", 500_000, "Approved", "Bangkok", 30)], [False, True]),
    ("LOCATION_JUMP", same(500_000, "Approved", [0, 10, 20, 30, 40]), [False] * 5),
    ("LOCATION_JUMP", [("ACC1", 500_000, "Approved", "Hanoi", 0), ("ACC1", 500_000, "Approved", "Bangkok", 3700)], [False]),
    ("DECLINED_BURST", same(50_000, "Declined", [0, 20, 40]), [False, False, True]),
    ("DECLINED_BURST", [("ACC1", 50_000, s, "Hanoi", t) for s, t in [("declined", 0), ("DECLINED", 10), ("Declined", 20)]], [True]),
    ("DECLINED_BURST", same(50_000, "Approved", [0, 5, 10, 15, 20]), [False] * 5),
    ("DECLINED_BURST", same(50_000, "Declined", [0, 60, 150]), [False]),
    ("RAPID_MICROPAYMENTS", same(5_000, "Approved", [0, 10, 20]), [False, False, True]),
    ("RAPID_MICROPAYMENTS", [("ACC1", a, "Approved", "Hanoi", s) for a, s in [(2_000, 0), (10_000, 5), (6_000, 10)]], [True]),
    ("RAPID_MICROPAYMENTS", [("ACC1", a, "Approved", "Hanoi", s) for a, s in [(1_999, 0), (10_001, 5), (M, 10)]], [False]),
    ("RAPID_MICROPAYMENTS", same(5_000, "Approved", [0, 60, 150]), [False]),
    # Both ends of a window count, equal times count, and case matters for Approved.
    ("HIGH_FREQUENCY", same(120 * M, "Approved", [0, 1800, 3600]), [False, False, True]),
    ("DECLINED_BURST", same(50_000, "Declined", [0, 60, 120]), [False, False, True]),
    ("LOCATION_JUMP", [("ACC1", 1, "Approved", "Hanoi", 0), ("ACC1", 1, "Approved", "Da Nang", 3600)], [False, True]),
    ("LOCATION_JUMP", [("ACC1", 1, "Approved", "Hanoi", 0), ("ACC1", 1, "Approved", "Da Nang", 0)], [False, True]),
    ("RAPID_MICROPAYMENTS", same(5_000, "Approved", [0, 0, 0, 0]), [False, False, True, True]),
    ("HIGH_FREQUENCY", same(120 * M, "approved", [0, 1, 2]), [False] * 3),
]
PATTERNS = {p.name: p for p in cep.CepConfig().patterns}


@pytest.mark.parametrize("name,rows,expected", GOLDEN)
def test_golden_pattern_cases(spark, name, rows, expected):
    # A narrow slice, so that the cases also cross slice borders.
    for slice_s in (86_400, 45):
        got = [r.fired for r in cep.pattern_alone(frame(spark, rows), PATTERNS[name], slice_s).orderBy("transaction_id").collect()]
        assert got[-len(expected):] == expected


def random_rows(seed, n=1500):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        rows.append((
            f"ACC_{min(rng.randrange(8), 4)}",  # one account holds half of the rows
            rng.choice([150 * M, 5_000, 7_000, 70_000]),
            rng.choice(["Approved", "Approved", "Declined"]),
            rng.choice(["Hanoi"] * 40 + ["Tokyo"]),
            rng.randrange(0, 40_000),  # whole seconds: many ties
        ))
    return rows


@pytest.mark.parametrize("seed,slice_s,rows_per_slice", [(1, 86_400, None), (2, 3_600, None), (3, 600, None), (4, 86_400, 300)])
def test_cascade_equals_fold(spark, seed, slice_s, rows_per_slice):
    windows = {"LOCATION_JUMP": 300, "HIGH_FREQUENCY": 200, "DECLINED_BURST": 120, "RAPID_MICROPAYMENTS": 120}
    config = cep.CepConfig(slice_s=slice_s, rows_per_slice=rows_per_slice).with_windows(**windows)
    df = frame(spark, random_rows(seed)).withColumn("blocked", F.pmod(F.xxhash64("transaction_id"), F.lit(9)) == 0)
    got = cep.cep_decide(df, config, ~F.col("blocked")).withColumn("ms", F.unix_millis("event_time")).collect()
    rows = [r.asDict() for r in got]
    want = cep_fold(rows, windows, lambda r: not r["blocked"])
    assert len(rows) == len(want) == 1500
    assert {r["transaction_id"]: r["cep_pattern"] for r in rows} == want
    assert set(want.values()) == {None, *windows}


def test_cascade_is_one_exchange_and_one_sort(spark):
    plan = cep.cep_decide(frame(spark, random_rows(1, 10)))._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("Exchange hashpartitioning") == 1
    assert initial.count("Sort [") == 1


def test_config_from_properties(spark):
    config = cep.CepConfig.from_properties({"cep.declined-burst.threshold": "2", "cep.declined-burst.window.seconds": "10"})
    burst = {p.name: p for p in config.patterns}["DECLINED_BURST"]
    assert (burst.threshold, burst.window_s) == (2, 10)
    assert config.lookback_s == 3600 + 3600 + 10 + 120


def test_custom_pattern(spark):
    df = cep.windowed_count(frame(spark, same(5, "Approved", [0, 1])), lambda: F.col("amount") == 5, 1, 10)
    assert [r.fired for r in df.collect()] == [True, True]


def test_only_busy_accounts_are_cut_finer(spark):
    df = frame(spark, random_rows(5, 400)).withColumn("_ms", F.unix_millis("event_time"))
    widths = with_widths(df, "_ms", 86_400_000, 600_000, 100).select("account_id", "_width").distinct().collect()
    finer = {r.account_id for r in widths if r._width < 86_400_000}
    assert finer == {"ACC_4"} and min(r._width for r in widths) >= 600_000


def test_a_busy_account_is_cut_finer_unless_turned_off(spark):
    """One account with a third of the rows, all within one day: its largest group stays near the given number."""
    rows = [("busy" if i % 3 == 0 else f"a{i % 50}", i * 10) for i in range(6000)]
    df = spark.createDataFrame(rows, "account_id string, s long").select(
        F.monotonically_increasing_id().cast("string").alias("transaction_id"), "account_id", F.timestamp_seconds(F.col("s")).alias("event_time"),
        F.lit(5000).cast("long").alias("amount"), F.lit("Approved").alias("status"), F.lit("Hanoi").alias("location_name"),
    )
    config = cep.CepConfig(rows_per_slice=300).with_windows(LOCATION_JUMP=300, HIGH_FREQUENCY=300, DECLINED_BURST=120, RAPID_MICROPAYMENTS=120)
    most = lambda c: cep.sliced(df, c).groupBy("account_id", cep.SLICE).count().agg(F.max("count")).first()[0]
    assert most(config) < 700 < 1900 < most(replace(config, rows_per_slice=None))
    assert cep.CepConfig().rows_per_slice is not None
    fired = [sorted(r.transaction_id for r in cep.cep_decide(df, c).filter("cep_pattern IS NOT NULL").collect()) for c in (config, replace(config, rows_per_slice=None))]
    assert fired[0] == fired[1] and fired[0]

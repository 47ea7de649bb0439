import random

import numpy as np
import pytest
from folds import cep_fold
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_cep import frame, random_rows
from test_ingest import GOOD, RULE, raw, without

from riskengine import schemas
from riskengine.constants import FEATURES
from riskengine.operators.cep import CepConfig, cep_decide
from riskengine.operators.rules import active_rules
from riskengine.plans.decide import decide
from riskengine.streaming import jobs, stateful

WINDOWS = {"LOCATION_JUMP": 300, "HIGH_FREQUENCY": 200, "DECLINED_BURST": 120, "RAPID_MICROPAYMENTS": 120}
CONFIG = CepConfig().with_windows(**WINDOWS)
CASCADE = list(WINDOWS)


def in_files(df, path, parts):
    """Time-ordered files, one per micro-batch."""
    df = df.withColumn("part", F.ntile(parts).over(Window.orderBy("event_time", "transaction_id")))
    for i in range(1, parts + 1):
        df.filter(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def updates(spark):
    rows = [("R1", "amount", "EQ", 70_000, None, "ALERT", True, 1, None), ("R2", "account_id", "EQ", None, "ACC_0", "BLOCK", True, 2, None),
            ("R2", "account_id", "EQ", None, "ACC_0", "BLOCK", False, 3, None)]
    return spark.createDataFrame(rows, schemas.RULE_UPDATE)


def rows_for(spark, seed, n=300):
    return frame(spark, random_rows(seed, n)).withColumn("produced_at", F.col("event_time")).withColumn(
        "decided_at", F.col("event_time")
    ).withColumn("ml_score", (F.pmod(F.xxhash64("transaction_id"), F.lit(100)) / 100.0))


def test_decide_stream_equals_batch(spark, tmp_path):
    df = rows_for(spark, 5)
    in_files(df, str(tmp_path / "in"), 3)
    decider = jobs.Decider(jobs.DecisionLog(str(tmp_path / "out")), lambda: updates(spark), CONFIG, ("ACC_1",))
    q = jobs.decide_stream(stream(spark, str(tmp_path / "in"), df.schema), decider, str(tmp_path / "cp"), availableNow=True)
    q.awaitTermination(240)
    assert q.exception() is None
    want = decide(df, active_rules(updates(spark)), CONFIG, ("ACC_1",))
    key = lambda d: {r.transaction_id: (r.rule_hit, r.cep_pattern, r.decision) for r in d.collect()}
    got = decider.log.read(spark)
    assert got.count() == 300 and key(got) == key(want)
    # A batch that is run again replaces its rows and sees the same history.
    again = spark.read.parquet(str(tmp_path / "out" / "log")).filter("batch_id = 1").select("transaction_id")
    decider(df.join(again, "transaction_id"), 1)
    assert decider.log.read(spark).count() == 300 and key(decider.log.read(spark)) == key(want)


def test_replayed_rows_are_decided_once(spark, tmp_path):
    df = rows_for(spark, 8, 200)
    part = F.ntile(2).over(Window.orderBy("event_time", "transaction_id"))
    first, second = (df.withColumn("part", part).filter(F.col("part") == i).drop("part") for i in (1, 2))
    decider = jobs.Decider(jobs.DecisionLog(str(tmp_path / "out")), lambda: updates(spark), CONFIG, ("ACC_1",))
    decider(first.union(first), 0)
    decider(second.union(first).union(second), 1)
    want = decide(df, active_rules(updates(spark)), CONFIG, ("ACC_1",))
    got = decider.log.read(spark)
    key = lambda d: sorted((r.transaction_id, r.rule_hit or "", r.cep_pattern or "", r.decision) for r in d.collect())
    assert got.count() == 200 and key(got) == key(want)


def test_rules_take_effect_with_the_next_batch(spark, tmp_path):
    rules_raw = raw(spark, RULE | {"threshold": 1_000})
    rules_raw.write.parquet(str(tmp_path / "rules-in"))
    table = str(tmp_path / "rules")
    decider = jobs.Decider(jobs.DecisionLog(str(tmp_path / "out")), lambda: jobs.read_rule_table(spark, table))
    batch = frame(spark, [("ACC1", 5_000, "Approved", "Hanoi", 0)]).withColumn("produced_at", F.col("event_time"))
    batch = batch.withColumn("ml_score", F.lit(0.1))
    decider(batch, 0)
    q = jobs.rule_stream(
        stream(spark, str(tmp_path / "rules-in"), schemas.MESSAGE), table, str(tmp_path / "dlq"), str(tmp_path / "cp"), availableNow=True
    )
    q.awaitTermination(120)
    decider(batch.withColumn("transaction_id", F.lit("later")), 1)
    got = {r.transaction_id: (r.rule_hit, r.decision) for r in decider.log.read(spark).collect()}
    assert got == {"ACC1-0000": (None, "APPROVED"), "later": ("R1", "BLOCK")}


def test_messages_are_split_and_scored(spark, tmp_path):
    raw(spark, GOOD, "nope", without(GOOD, "amount")).write.parquet(str(tmp_path / "in"))

    def score(rows):
        return np.where(rows[:, FEATURES.index("log_amount_ratio_24h")] > 0.5, 0.95, 0.1)

    decider = jobs.Decider(jobs.DecisionLog(str(tmp_path / "out")), lambda: jobs.read_rule_table(spark, str(tmp_path / "none")), score=score)
    q = jobs.decide_messages(
        stream(spark, str(tmp_path / "in"), schemas.MESSAGE), decider, str(tmp_path / "dlq"), str(tmp_path / "cp"), availableNow=True
    )
    q.awaitTermination(120)
    assert q.exception() is None
    r = decider.log.read(spark).collect()
    assert [(x.transaction_id, x.decision) for x in r] == [(GOOD["transaction_id"], "ALERT")]  # ln(2) > 0.5
    assert spark.read.text(str(tmp_path / "dlq")).count() == 2


def run_rows(rows):
    """The stateful step over rows in arrival order."""
    steps = stateful._steps(CONFIG)
    state, out = {}, {}
    for r in rows:
        times, values = state.setdefault(r["account_id"], ([[] for _ in steps], [None] * len(steps)))
        tests = [
            r["location_name"], r["amount"] > 100_000_000 and r["status"] == "Approved", r["status"] == "Declined",
            2_000 <= r["amount"] <= 10_000,
        ]
        out[r["transaction_id"]] = stateful.advance(steps, times, values, r["ms"], tests)
    return out


def test_fixed_size_state_equals_fold():
    rows = [
        {"transaction_id": f"{a}-{i:04d}", "account_id": a, "amount": m, "status": s, "location_name": loc, "ms": t * 1000}
        for i, (a, m, s, loc, t) in enumerate(random_rows(9, 3000))
    ]
    rows.sort(key=lambda r: (r["account_id"], r["ms"], r["transaction_id"]))
    assert run_rows(rows) == cep_fold(rows, WINDOWS)


def test_cep_stream_equals_batch(spark, tmp_path):
    df = rows_for(spark, 6)
    in_files(df, str(tmp_path / "in"), 3)

    q = stateful.cep_stream(stream(spark, str(tmp_path / "in"), df.schema), CONFIG).writeStream.foreachBatch(
        lambda b, i: jobs.write_batch(b, str(tmp_path / "out"), i)
    ).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    got = {r.transaction_id: r.cep_pattern for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.transaction_id: r.cep_pattern for r in cep_decide(df, CONFIG).collect()}
    assert len(got) == 300 and got == want


def test_metrics_stream_and_replays(spark, tmp_path):
    df = rows_for(spark, 7, 50)
    df.unionByName(df).coalesce(1).write.parquet(str(tmp_path / "in"))
    unique = jobs.without_replays(stream(spark, str(tmp_path / "in"), df.schema))
    q = unique.writeStream.format("memory").queryName("unique_rows").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("unique_rows").count() == 50


def test_metrics_come_once_and_add_up(spark, tmp_path):
    """Seconds are appended once; sketches merged to hours are within the error bound of the exact percentiles."""
    df = spark.range(20_000).selectExpr(
        "timestamp_micros(1767225600000000 + id * 700000) AS produced_at",
        "timestamp_micros(1767225600000000 + id * 700000 + (id * 7919 % 5003) * 1000) AS decided_at",
    )
    closing = df.selectExpr("max(decided_at) + INTERVAL 1 MINUTE AS t").selectExpr("t AS produced_at", "t AS decided_at")
    for part in (df, closing):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = jobs.write_metrics(
            jobs.metrics_stream(stream(spark, str(tmp_path / "in"), df.schema)), str(tmp_path / "out"), str(tmp_path / "cp"), availableNow=True
        )
        q.awaitTermination(120)
        assert q.exception() is None
    seconds = spark.read.parquet(str(tmp_path / "out"))
    assert seconds.count() == seconds.select("second").distinct().count() and seconds.agg(F.sum("n")).first()[0] == 20_000
    for r in jobs.with_quantiles(jobs.metric_spans(seconds, "hour")).collect():
        own = sorted(i * 7919 % 5003 for i in range(20_000) if (i * 700 + i * 7919 % 5003) // 3_600_000 == (r.hour.timestamp() - 1767225600) // 3600)
        assert len(own) == r.n and max(own) == r.max_ms
        for name, p in jobs.METRIC_QUANTILES.items():
            rank = sum(v <= r[name] for v in own) / len(own)
            assert abs(rank - p) < 0.005


@pytest.mark.parametrize("batches", [1, 4, 16])
def test_scored_stream_does_not_depend_on_batches(spark, tmp_path, batches):
    """Chains of decisions run on across the ends of batches: busy accounts within a day."""
    df = frame(spark, random_rows(12, 160)).withColumn("produced_at", F.col("event_time")).withColumn("decided_at", F.col("event_time"))

    def score(rows):
        ratio = rows[:, FEATURES.index("log_amount_ratio_24h")]
        return ratio / (1 + ratio) + rows[:, FEATURES.index("is_home")] / 10

    decider = jobs.Decider(jobs.DecisionLog(str(tmp_path / "out")), lambda: updates(spark), CONFIG, ("ACC_1",), 0.45, score, rows_per_slice=None)
    part = F.ntile(batches).over(Window.orderBy("event_time", "transaction_id"))
    rows = df.withColumn("part", part)
    for i in range(1, batches + 1):
        decider(rows.filter(F.col("part") == i).drop("part"), i)
    want = decide(df, active_rules(updates(spark)), CONFIG, ("ACC_1",), 0.45, score)
    key = lambda d: {r.transaction_id: (r.rule_hit, r.cep_pattern, r.decision, r.ml_score and round(r.ml_score, 5)) for r in d.collect()}
    got = key(decider.log.read(spark))
    assert got == key(want)
    assert len({v[2] for v in got.values() if v[3] is not None}) == 2


def test_replayed_ids_are_not_broadcast(spark):
    """The history's ids grow with the look-back: they are met by a shuffle, not sent through the driver."""
    batch = spark.createDataFrame([("1", "a"), ("2", "a"), ("2", "a"), (None, "b")], "transaction_id STRING, account_id STRING")
    history = spark.createDataFrame([("2", "a"), ("3", "a")], "transaction_id STRING, account_id STRING")
    first = jobs._first_seen(batch, history)
    assert sorted(first.collect(), key=str) == sorted([("1", "a"), (None, "b")], key=str)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskengine.operators import joins, prefix
from riskengine.operators.dedup import latest_by_key
from riskengine.plans import profile, reports

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)


def labelled(seed=1, n=400, hot=0.4):
    """Scores with ties; one score holds much of the rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        score = 0.5 if rng.random() < hot else rng.randrange(40) / 40
        fraud = rng.random() < score
        out.append((f"t{i}", score, fraud, "ALERT" if score >= 0.7 else "APPROVED", rng.choice(["A", "B"])))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, ml_score double, is_fraud boolean, decision string, fraud_pattern string")


@pytest.mark.parametrize("per_bucket", [1_000_000, 5])
def test_ranking_figures(spark, per_bucket):
    rows = labelled()
    df = frame(spark, rows)
    score, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    pos, neg = score[y], score[~y]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert reports.auc_roc(df, rows_per_bucket=per_bucket).first()[0] == pytest.approx(wins / len(pos) / len(neg))
    rank = np.array([1 + (score < s).sum() for s in score])
    p = y.sum()
    low = (rank[y].sum() - p * (p + 1) / 2) / (p * (~y).sum())
    assert reports.auc_roc(df, ties="min", rows_per_bucket=per_bucket).first()[0] == pytest.approx(low)
    cuts = sorted(set(score))
    precision = {c: y[score >= c].mean() for c in cuts}
    recall = {c: y[score >= c].sum() / p for c in cuts}
    ap = sum(precision[c] * (y & (score == c)).sum() / p for c in cuts)
    assert reports.auc_pr(df, rows_per_bucket=per_bucket).first()[0] == pytest.approx(ap)
    f1 = [2 * precision[c] * recall[c] / (precision[c] + recall[c] + 1e-8) for c in cuts]
    best = reports.best_threshold(df, rows_per_bucket=per_bucket).first()
    assert best.threshold == cuts[int(np.argmax(f1))] and best.f1 == pytest.approx(max(f1))


def test_row_order_average_precision(spark):
    import hashlib

    rows = labelled(3)
    ordered = sorted(rows, key=lambda r: (-r[1], hashlib.md5(r[0].encode()).hexdigest()))
    tp, total = 0, 0.0
    for i, r in enumerate(ordered, 1):
        tp += r[2]
        total += r[2] * tp / i
    assert reports.auc_pr(frame(spark, rows), ties="row", rows_per_bucket=4).first()[0] == pytest.approx(total / tp)


def test_no_positives_or_no_rows_gives_null(spark):
    none = frame(spark, [(f"t{i}", 0.1 * i, False, "APPROVED", "A") for i in range(3)])
    for df in (none, none.limit(0)):
        assert reports.auc_roc(df).first()[0] is None and reports.auc_pr(df).first()[0] is None
        assert reports.fdr(df).first()[0] is None
        assert reports.detection_rates(df).first().detection_rate == 0.0


@pytest.mark.parametrize("per_bucket", [1_000_000, 7])
def test_exact_quantiles(spark, per_bucket):
    rng = random.Random(5)
    rows = [("a" if rng.random() < 0.8 else "b", rng.choice([7, rng.randrange(1000)])) for _ in range(500)] + [("c", 3)]
    df = spark.createDataFrame(rows, "g string, v long")
    ps = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    for r in prefix.exact_quantiles(df, "v", ps, ["g"], per_bucket).collect():
        want = np.quantile([v for g, v in rows if g == r.g], list(ps.values()))
        assert [r[p] for p in ps] == pytest.approx(list(want))


def test_prefix_sums_over_many_buckets(spark):
    df = spark.range(1000).selectExpr("id AS v", "id % 7 AS m")
    got = prefix.prefix_sums(df, "v", ["m"], descending=True, rows_per_bucket=10).orderBy(F.desc("v")).collect()
    running = 0
    for r in got:
        assert (r.m_before, r.m_total) == (running, sum(i % 7 for i in range(1000)))
        running += r.m


def decisions(spark, n=200):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        produced = T0 + timedelta(milliseconds=rng.randrange(20_000))
        rows.append((f"t{i}", rng.choice(["ACC_1", "ACC_2", "FRD_RULE_UPDATE_ACC_7"]), produced, produced + timedelta(milliseconds=rng.randrange(900)), rng.choice(["BLOCK", "APPROVED"])))
    return rows, spark.createDataFrame(rows, "transaction_id string, account_id string, produced_at timestamp, decided_at timestamp, decision string")


def ms(d):
    return d // timedelta(milliseconds=1)


def test_latency_reports(spark):
    rows, df = decisions(spark)
    kept = [r for r in rows if not r[1].startswith("FRD")]
    log = reports.report_rows(df)
    assert reports.total_transactions(log).first()[0] == len(kept)
    lat = [ms(r[3] - r[2]) for r in kept]
    got = reports.latency_percentiles(log, 10).first()
    assert [got.p50_ms, got.p99_ms, got.max_ms] == pytest.approx([np.quantile(lat, 0.5), np.quantile(lat, 0.99), max(lat)])
    inside = reports.report_rows(df, T0 + timedelta(seconds=5), T0 + timedelta(seconds=10))
    assert inside.count() == sum(T0 + timedelta(seconds=5) <= r[2] < T0 + timedelta(seconds=10) for r in kept)
    assert sum(r.n for r in reports.throughput(log, "decided_at").collect()) == len(kept)


def test_levels_overlap_and_empty(spark):
    rows, df = decisions(spark)
    s = lambda x: T0 + timedelta(seconds=x)
    levels = [(500, s(0), s(8)), (1000, s(4.5), s(12)), (3000, s(100), s(160))]
    table = spark.createDataFrame(levels, 'tps long, start timestamp, end timestamp')
    got = {r.tps: r for r in reports.latency_by_level(df, table, 1_000_000).collect()}
    for tps, a, b in levels:
        lat = [ms(r[3] - r[2]) for r in rows if a <= r[2] < b]
        assert got[tps].n == len(lat)
        assert got[tps].avg_ms == (pytest.approx(sum(lat) / len(lat)) if lat else None)


def test_rule_propagation(spark):
    rows, df = decisions(spark)
    sent = [(f"R{i}", f"ACC_{1 + i % 2}", T0 + timedelta(seconds=i * 3)) for i in range(8)]
    found = reports.rule_propagation_latency(spark.createDataFrame(sent, "rule_id string, account_id string, sent_at timestamp"), df)
    want = {}
    for rule, account, at in sent:
        blocks = [r[3] for r in rows if r[1] == account and r[4] == "BLOCK" and r[2] >= at]
        if blocks:
            want[rule] = ms(min(blocks) - at)
    got = {r.rule_id: r.latency_ms for r in found.collect()}
    assert got == want and 0 < len(want)
    assert reports.mean_propagation(found).first().mean_latency_ms == pytest.approx(sum(want.values()) / len(want))


def test_latest_by_key_and_members(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, o int, v string")
    assert {r.k: r.v for r in latest_by_key(df, ["k"], ["o"]).collect()} == {"a": "y", "b": None}
    got = joins.members(df, df.filter("v = 'x'"), "k", "o")
    assert got.count() == 3 and got.columns == df.columns
    left = joins.salted_join(df, spark.createDataFrame([("b", 5)], "k string, w int"), "k", "left", "o")
    assert sorted((r.k, r.w) for r in left.collect() if r.w) == [("b", 5)] and left.count() == 4


def test_account_split(spark):
    rows = [(f"A{i % 100}", i % 100 < 10 and i >= 100, f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "account_id string, is_fraud boolean, transaction_id string")
    split = profile.account_split(df)
    n = {(r.has_fraud, r.part): r["count"] for r in split.groupBy("has_fraud", "part").count().collect()}
    assert n == {(True, "train"): 8, (True, "test"): 2, (False, "train"): 72, (False, "test"): 18}
    parts = profile.with_part(df, split)
    assert parts.count() == 300
    assert parts.select("account_id", "part").distinct().count() == 100
    assert split.join(profile.account_split(df, seed=7).withColumnRenamed("part", "p2"), "account_id").filter("part <> p2").count() > 0


@pytest.mark.parametrize("limit", [0, 1000])
def test_lookups_by_broadcast_and_by_salt(spark, limit):
    _, df = decisions(spark)
    table = spark.createDataFrame([("ACC_1", 1), ("ACC_2", 2)], "account_id string, w int")
    got = joins.lookup_join(df, table, "account_id", "left", "transaction_id", limit)
    assert {(r.account_id, r.w) for r in got.collect()} == {("ACC_1", 1), ("ACC_2", 2), ("FRD_RULE_UPDATE_ACC_7", None)}
    assert got.count() == 200
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("_salt" in plan) == (limit == 0)
    spans = spark.createDataFrame([(1, T0, T0 + timedelta(seconds=5)), (2, T0 + timedelta(seconds=3), T0 + timedelta(seconds=9))], "i int, a timestamp, b timestamp")
    met = joins.interval_join(df, spans, "produced_at", "a", "b", 1_000_000, "transaction_id", limit)
    want = df.join(spans, (F.col("produced_at") >= F.col("a")) & (F.col("produced_at") < F.col("b")))
    key = lambda d: sorted((r.transaction_id, r.i) for r in d.collect())
    assert key(met) == key(want) and met.columns == want.columns


@pytest.mark.parametrize("many", [1_000_000, 3])
def test_null_groups_and_values_stay(spark, many):
    rows = [(g, v) for g in ("a", None) for v in range(10)] + [("a", None), (None, None)]
    df = spark.createDataFrame(rows, "g string, v long").withColumn("n", F.lit(1).cast("long"))
    sums = prefix.prefix_sums(df, "v", ["n"], ["g"], rows_per_bucket=many)
    assert sums.columns == ["g", "v", "n", "n_before", "n_total"]
    got = {(r.g, r.v): (r.n_before, r.n_total) for r in sums.collect()}
    assert got == {(g, v): (0 if v is None else v + 1, 11) for g, v in rows}
    q = {r.g: r.p50 for r in prefix.exact_quantiles(df, "v", {"p50": 0.5}, ["g"], rows_per_bucket=many).collect()}
    assert q == {"a": 4.5, None: 4.5}
    ranked = prefix.hashed_rank(df.withColumn("k", F.col("v").cast("string")), ["g"], "k").collect()
    assert len(ranked) == len(rows) and {r.group_size for r in ranked} == {11}


def test_input_is_read_once(spark):
    """Figures that need cuts, offsets or several aggregates read their rows once; what they read again is small."""
    rows = [(f"t{i}", f"A{i % 7}" if i % 11 else None, i % 10 / 10, i % 3 == 0, i % 50 if i % 13 else None, T0 + timedelta(minutes=i)) for i in range(300)]
    plain = spark.createDataFrame(rows, "transaction_id string, account_id string, ml_score double, is_fraud boolean, amount long, event_time timestamp")
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    def rounded(x):
        """Sums of floats differ in the last digit by the order of their rows."""
        return [rounded(v) for v in x] if isinstance(x, (tuple, list)) else round(x, 9) if isinstance(x, float) else x

    counted = plain.mapInPandas(seen, plain.schema)
    figures = {
        "auc_roc": lambda df: reports.auc_roc(df, rows_per_bucket=3),
        "auc_pr": lambda df: reports.auc_pr(df, rows_per_bucket=3),
        "auc_pr_by_row": lambda df: reports.auc_pr(df, ties="row", rows_per_bucket=3),
        "best_threshold": lambda df: reports.best_threshold(df, rows_per_bucket=3),
        "ranking_report": lambda df: reports.ranking_report(df, rows_per_bucket=3),
        "profile": lambda df: profile.profile(df, rows_per_bucket=3),
        "box": lambda df: profile.amount_box(df, rows_per_bucket=3),
        "quantiles": lambda df: prefix.exact_quantiles(df, "amount", {"m": 0.5}, ["is_fraud"], rows_per_bucket=3),
    }
    for name, figure in figures.items():
        before = read.value
        got = figure(counted).collect()
        assert read.value - before == len(rows), name
        assert rounded(got) == rounded(figure(plain).collect()), name


def test_profile_of_nulls_and_of_nothing(spark):
    schema = "account_id string, amount long, event_time timestamp, is_fraud boolean"
    rows = [("A", 1, T0, True), ("A", None, T0, False), (None, 4, T0, None), ("B", 7, None, False)]
    got = profile.profile(spark.createDataFrame(rows, schema)).first()
    assert (got.total_rows, got.fraud_rows, got.accounts, got.amount_count) == (4, 1, 2, 3)
    assert (got.amount_mean, got.amount_std, got.q50, got.amount_min, got.amount_max) == (4.0, 3.0, 4.0, 1, 7)
    empty = profile.profile(spark.createDataFrame([], schema)).first()
    assert (empty.total_rows, empty.fraud_rows, empty.accounts, empty.amount_mean, empty.q50) == (0, 0, 0, None, None)

import random
from datetime import datetime, timedelta, timezone

import pytest
import numpy as np
from pyspark.sql import functions as F

from riskengine import schemas
from riskengine.functions import predicates as P
from riskengine.operators import rules, steps
from riskengine.plans import decide as D

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)
COMPARE = {
    "GT": lambda a, b: a > b, "GTE": lambda a, b: a >= b, "LT": lambda a, b: a < b, "LTE": lambda a, b: a <= b,
    "EQ": lambda a, b: a == b, "NEQ": lambda a, b: a != b,
}


def matches(rule, tx):
    if rule["field"] == "amount":
        return rule["operator"] in COMPARE and COMPARE[rule["operator"]](tx[1], rule["threshold"] or 0)
    if rule["field"] == "account_id" and rule["value"] is not None and rule["operator"] in ("EQ", "NEQ"):
        return COMPARE[rule["operator"]](tx[2], rule["value"])
    return False


def first(rules_, tx, prefer_block=False):
    hits = sorted((prefer_block and r["action"] != "BLOCK", r["rule_id"]) for r in rules_ if matches(r, tx))
    return hits[0][1] if hits else None


def transactions(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = [(f"t{i}", rng.randrange(0, 60), f"ACC_{rng.randrange(12)}", T0 + timedelta(seconds=rng.randrange(4000))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "transaction_id string, amount long, account_id string, produced_at timestamp")


def random_rules(seed, n, with_neq):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        field = rng.choice(["amount", "amount", "account_id", "channel"])
        ops = ["EQ"] + (["NEQ"] if with_neq else []) if field == "account_id" else ["GT", "GTE", "LT", "LTE", "EQ", "IN"]
        op = rng.choice(ops)
        # Thresholds near the ends, so that not every row is taken by the first rule.
        threshold = {"GT": rng.randrange(45, 70), "GTE": rng.randrange(45, 70), "LT": rng.randrange(0, 15), "LTE": rng.randrange(0, 15)}.get(op, rng.randrange(60))
        out.append({
            "rule_id": f"R{rng.randrange(10**6):06d}-it's", "field": field, "operator": op,
            "threshold": rng.choice([threshold, threshold, threshold, None]) if op != "GTE" else threshold,
            "value": rng.choice([f"ACC_{rng.randrange(12)}", None]), "action": rng.choice(["BLOCK", "ALERT", "LOG"]), "enabled": True,
        })
    return out


@pytest.mark.parametrize("seed,with_neq", [(1, False), (2, True), (3, False)])
@pytest.mark.parametrize("prefer_block", [False, True])
def test_all_paths_equal_brute_force(spark, monkeypatch, seed, with_neq, prefer_block):
    some = random_rules(seed, 25, with_neq)
    if with_neq:
        some += [{**some[0], "rule_id": f"Z{i}", "field": "amount", "operator": "NEQ", "threshold": i // 2} for i in range(6)]
    rows, tx = transactions(spark, seed=seed)
    table = spark.createDataFrame([tuple(r.values()) for r in some], schemas.RULE)
    want = {t[0]: first(some, t, prefer_block) for t in rows}
    for limit, inline in ((64, 64), (0, 64), (0, 0)):
        monkeypatch.setattr(rules, "INLINE_RULES", inline)
        got = rules.apply_rules(tx, table, prefer_block, limit).collect()
        assert {r.transaction_id: r.rule_hit for r in got} == want
        status = {r["rule_id"]: "BLOCK" if r["action"] == "BLOCK" else "ALERT" for r in some}
        assert all(r.rule_status == status.get(r.rule_hit) for r in got)


@pytest.mark.parametrize("seed,with_neq,few_steps", [(4, False, 64), (5, True, 0)])
def test_asof_equals_brute_force(spark, monkeypatch, seed, with_neq, few_steps):
    rng = random.Random(seed)
    monkeypatch.setattr(steps, "FEW_STEPS", few_steps)
    updates = []
    for i, r in enumerate(random_rules(seed, 40, with_neq)):
        at = T0 + timedelta(seconds=100 * i + rng.randrange(50))
        updates.append({**r, "rule_id": f"R{i % 7}", "enabled": rng.random() < 0.8, "seq": i, "updated_at": at})
    rows, tx = transactions(spark, seed=seed)
    table = spark.createDataFrame([tuple(u.values()) for u in updates], schemas.RULE_UPDATE)

    def state(t):
        newest = {}
        for u in updates:
            if u["updated_at"] <= t:
                newest[u["rule_id"]] = u
        return [u for u in newest.values() if u["enabled"]]

    want = {t[0]: first(state(t[3]), t) for t in rows}
    for few in (rules.FEW_VERSIONS, 0):
        got = rules.apply_rules_asof(tx, table, "produced_at", few=few).collect()
        assert {r.transaction_id: r.rule_hit for r in got} == want
    assert len(set(want.values())) > 3
    assert rules.apply_rules_asof(tx, table.limit(0)).filter("rule_hit IS NOT NULL").isEmpty()


def test_asof_busy_hour_is_not_gathered(spark, monkeypatch):
    """Few versions in all, but more than FEW_PER_HOUR in one hour: each transaction would test every one of them."""
    rng = random.Random(6)
    gathered = []
    monkeypatch.setattr(rules, "_asof_few", lambda *a: gathered.append(a))
    updates = []
    for i, r in enumerate(random_rules(6, 400, True)):
        at = T0 + timedelta(seconds=10 * i + rng.randrange(5))
        updates.append({**r, "rule_id": f"R{i % 7}", "enabled": rng.random() < 0.8, "seq": i, "updated_at": at})
    rows, tx = transactions(spark, seed=6)
    table = spark.createDataFrame([tuple(u.values()) for u in updates], schemas.RULE_UPDATE)

    def state(t):
        newest = {}
        for u in updates:
            if u["updated_at"] <= t:
                newest[u["rule_id"]] = u
        return [u for u in newest.values() if u["enabled"]]

    got = rules.apply_rules_asof(tx, table, "produced_at").collect()
    assert not gathered
    assert {r.transaction_id: r.rule_hit for r in got} == {t[0]: first(state(t[3]), t) for t in rows}


def test_active_rules_disable_and_replace(spark):
    rows = [("A", "amount", "GT", 1, None, "BLOCK", True, 1, None), ("A", "amount", "GT", 9, None, "BLOCK", True, 3, None),
            ("B", "amount", "GT", 1, None, "BLOCK", True, 2, None), ("B", "amount", "GT", 1, None, "BLOCK", False, 4, None)]
    got = rules.active_rules(spark.createDataFrame(rows, schemas.RULE_UPDATE)).collect()
    assert [(r.rule_id, r.threshold) for r in got] == [("A", 9)]


def test_unknown_operator_and_nulls_never_match(spark):
    df = spark.range(1).select(
        P.numeric_match(F.lit(5), F.lit("IN"), F.lit(5)).alias("a"), P.numeric_match(F.lit(5), F.lit("GT"), F.lit(None).cast("long")).alias("b"),
        P.string_match(F.lit(None).cast("string"), F.lit("NEQ"), F.lit("x")).alias("c"), P.string_match(F.lit("x"), F.lit("GT"), F.lit("a")).alias("d"),
    )
    assert tuple(df.first()) == (False, True, False, False)


def test_rule_lookup_does_not_shuffle_transactions(spark):
    _, tx = transactions(spark)
    table = spark.createDataFrame([tuple(r.values()) for r in random_rules(1, 10, False)], schemas.RULE)
    plan = rules.apply_rules(tx, table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_decide_priority_order(spark):
    """The allow-listed account passes before its blacklist rule, and is blocked after it."""
    rows = [("a", 10, "FRD_RULE_UPDATE_SC6", 8), ("b", 10, "FRD_RULE_UPDATE_SC6", 12), ("c", 2_000_000_000, "ACC_1", 1), ("d", 10, "ACC_1", 2), ("e", 10, "ACC_2", 2)]
    tx = spark.createDataFrame(rows, "transaction_id string, amount long, account_id string, s int").select(
        "*", F.timestamp_seconds(F.col("s") + 1767225600).alias("event_time"), F.lit("Hanoi").alias("location_name"), F.lit("Approved").alias("status"),
        F.when(F.col("account_id") == "ACC_1", 0.9184).otherwise(0.5).alias("ml_score"),
    ).withColumn("produced_at", F.col("event_time"))
    table = spark.createDataFrame([("AMOUNT_THRESHOLD", "amount", "GT", 1_000_000_000, None, "BLOCK", True)], schemas.RULE)
    early = {r.transaction_id: (r.decision, r.stage) for r in D.decide(tx, table).collect()}
    assert early == {"a": ("APPROVED", "PRIORITY"), "b": ("APPROVED", "PRIORITY"), "c": ("BLOCK", "RULE"), "d": ("ALERT", "ML"), "e": ("APPROVED", "ML")}
    black = spark.createDataFrame([("B", "account_id", "EQ", None, "FRD_RULE_UPDATE_SC6", "BLOCK", True)], schemas.RULE)
    late = {r.transaction_id: r.decision for r in D.decide(tx.filter("s >= 10"), black).collect()}
    assert late == {"b": "BLOCK"}
    out = D.to_decision(D.decide(tx, table, score=lambda rows: np.full(len(rows), 0.99)))
    assert out.columns == schemas.DECISION.fieldNames()
    assert sorted((r.transaction_id, r.decision) for r in D.alerts(out).collect()) == [("c", "BLOCK"), ("d", "ALERT"), ("e", "ALERT")]


def test_a_hundred_thousand_range_rules(spark):
    """All useful: the lower the threshold of a rule, the later it comes. None goes through the driver or one array."""
    n = 100_000
    table = spark.range(n).selectExpr(
        "concat('R', lpad(id, 6, '0')) AS rule_id", "'amount' AS field", "CASE WHEN id % 2 = 0 THEN 'GT' ELSE 'GTE' END AS operator",
        f"10 * ({n} - id) AS threshold", "CAST(NULL AS STRING) AS value", "'BLOCK' AS action", "true AS enabled",
    )
    amounts = [0, 10, 11, 19, 20, 21, 25, 10 * n - 1, 10 * n, 10 * n + 1, 2**62, None] + [random.Random(1).randrange(10 * n) for _ in range(200)]
    tx = spark.createDataFrame([(f"t{i}", "A", a) for i, a in enumerate(amounts)], "transaction_id string, account_id string, amount long")
    got = {r.amount: r.rule_hit for r in rules.apply_rules(tx, table).collect()}
    for a in amounts:
        # The first rule whose threshold the amount passes: t = 10 * (n - i), strictly for even i.
        want = None
        if a is not None and a >= 10:
            i = max(0, n - a // 10)
            want = i if a > 10 * (n - i) or i % 2 else i + 1
            want = want if want < n else None
        assert got[a] == (None if want is None else f"R{want:06d}"), a


def test_tree_nodes_make_up_the_leaves(spark):
    rng = random.Random(2)
    spans = [(0, 0), (0, 1), (0, 4096), (15, 17), (1, 4095), (16, 32), (255, 257)] + [tuple(sorted(rng.choices(range(4000), k=2))) for _ in range(200)]
    df = spark.createDataFrame(spans, "i long, j long").withColumn("n", steps.tree_nodes("i", "j", 3))
    for r in df.collect():
        leaves = [leaf for x in r.n for leaf in range(x.node * 16**x.level, (x.node + 1) * 16**x.level)]
        assert sorted(leaves) == list(range(r.i, r.j)) and len(r.n) <= 90

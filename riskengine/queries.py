"""The registered queries: each takes (spark, sf_dir), works on the whole tables and returns a DataFrame.

Times are returned as epoch microseconds and floats rounded, so that results compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskengine import schemas
from riskengine import testviews as V
from riskengine.constants import FEATURES, MODEL_TARGETS, SCORE_THRESHOLD
from riskengine.functions import predicates as P
from riskengine.operators import cep, features, joins, rules
from riskengine.operators.dedup import latest_by_key
from riskengine.operators.feedback import serve_in_order
from riskengine.plans import decide as D
from riskengine.plans import ml, profile, reports
from riskengine.session import shared_dir
from riskengine.sources import parsing, readers
from riskengine.sources.sinks import (
    drop_labels, overwrite_table, read_decisions, reset_table, write_batch, write_decisions, write_dlq_stream, write_ground_truth,
    write_report,
)
from riskengine.streaming import jobs, stateful

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# The data is sparse at the two-minute scale, so these two patterns look back half an hour.
CONFIG = cep.CepConfig().with_windows(DECLINED_BURST=1800, RAPID_MICROPAYMENTS=1800)
PRIORITY = ("ACC_00003", "ACC_00011")


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _us(col: str, name: str | None = None):
    return F.unix_micros(col).alias(name or f"{col}_us")


def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# Rules

@query
def active_rules(spark, sf_dir):
    return rules.active_rules(V.rule_updates(spark, sf_dir)).select(
        "rule_id", "field", "operator", "threshold", "value", "action", "seq"
    )


@query
def rules_first_match(spark, sf_dir):
    active = rules.active_rules(V.rule_updates(spark, sf_dir))
    return rules.apply_rules(V.transactions(spark, sf_dir), active).select("transaction_id", "rule_hit", "rule_status")


@query
def rules_first_match_joined(spark, sf_dir):
    """The same by the join path that long rule tables take, blocking rules first."""
    active = rules.active_rules(V.rule_updates(spark, sf_dir))
    hit = rules.apply_rules(V.transactions(spark, sf_dir), active, prefer_block=True, inline_limit=0)
    return hit.select("transaction_id", "rule_hit", "rule_status")


@query
def rules_asof(spark, sf_dir):
    hit = rules.apply_rules_asof(V.transactions(spark, sf_dir), V.rule_updates(spark, sf_dir), "produced_at")
    return hit.select("transaction_id", "rule_hit", "rule_status")


@query
def rules_asof_many(spark, sf_dir):
    """One rule per customer against an account and one per supplier against an amount, each for a while."""
    hit = rules.apply_rules_asof(V.transactions(spark, sf_dir), V.many_rule_updates(spark, sf_dir), "produced_at", few=0)
    return hit.select("transaction_id", "rule_hit", "rule_status")


OPERATORS = ("GT", "GTE", "LT", "LTE", "EQ", "NEQ", "IN")


@query
def rule_numeric_ops(spark, sf_dir):
    tx = V.transactions(spark, sf_dir)
    tests = [
        F.count_if(P.numeric_match(F.col("amount"), F.lit(op), F.lit(5_000_000).cast("long"))).alias(op.lower())
        for op in OPERATORS
    ]
    no_threshold = P.numeric_match(F.col("amount"), F.lit("GT"), F.lit(None).cast("long"))
    return tx.groupBy("channel").agg(*tests, F.count_if(no_threshold).alias("gt_missing"))


@query
def rule_string_ops(spark, sf_dir):
    tx = V.transactions(spark, sf_dir)
    account = F.col("account_id")
    tests = [
        F.count_if(P.string_match(account, F.lit(op), F.lit("ACC_00007"))).alias(op.lower()) for op in ("EQ", "NEQ", "GT")
    ]
    no_value = P.string_match(account, F.lit("NEQ"), F.lit(None).cast("string"))
    return tx.groupBy("channel").agg(*tests, F.count_if(no_value).alias("neq_missing"))


@query
def rule_propagation(spark, sf_dir):
    sent = V.rule_updates(spark, sf_dir).filter("field = 'account_id' AND enabled").select(
        F.concat_ws("#", "rule_id", F.col("seq").cast("string")).alias("rule_id"),
        F.col("value").alias("account_id"),
        F.col("updated_at").alias("sent_at"),
    )
    return reports.rule_propagation_latency(sent, V.decisions(spark, sf_dir)).select(
        "rule_id", "account_id", _us("first_block"), "latency_ms"
    )


@query
def rule_propagation_mean(spark, sf_dir):
    sent = V.rule_updates(spark, sf_dir).filter("field = 'account_id' AND enabled").select(
        F.concat_ws("#", "rule_id", F.col("seq").cast("string")).alias("rule_id"),
        F.col("value").alias("account_id"),
        F.col("updated_at").alias("sent_at"),
    )
    found = reports.rule_propagation_latency(sent, V.decisions(spark, sf_dir))
    return _round(reports.mean_propagation(found), 3, "mean_latency_ms")


# Patterns and decisions

def _fired(df: DataFrame) -> DataFrame:
    return df.select("transaction_id", "account_id", "fired")


@query
def cep_location_jump(spark, sf_dir):
    return _fired(cep.location_jump(V.transactions(spark, sf_dir)))


@query
def cep_high_frequency(spark, sf_dir):
    return _fired(cep.high_frequency(V.transactions(spark, sf_dir)))


@query
def cep_declined_burst(spark, sf_dir):
    return _fired(cep.declined_burst(V.transactions(spark, sf_dir), 1800))


@query
def cep_rapid_micropayments(spark, sf_dir):
    return _fired(cep.rapid_micropayments(V.transactions(spark, sf_dir), 1800))


@query
def cep_windowed_count(spark, sf_dir):
    online = lambda: F.col("channel") == "ONLINE"
    return _fired(cep.windowed_count(V.transactions(spark, sf_dir), online, 4, 7200))


@query
def cep_cascade(spark, sf_dir):
    return cep.cep_decide(V.transactions(spark, sf_dir), CONFIG).select("transaction_id", "cep_pattern")


def _decided(spark, sf_dir) -> DataFrame:
    active = rules.active_rules(V.rule_updates(spark, sf_dir))
    return D.decide(V.transactions(spark, sf_dir), active, CONFIG, PRIORITY)


@query
def decide(spark, sf_dir):
    return D.to_decision(_decided(spark, sf_dir), F.col("decided_at")).select(
        "transaction_id", "account_id", F.col("amount").cast("long").alias("amount"), "rule_hit", "cep_pattern",
        F.round(F.col("ml_score").cast("double"), 4).alias("ml_score"), _us("produced_at"), _us("decided_at"), "decision",
    )


@query
def decision_counts(spark, sf_dir):
    return _decided(spark, sf_dir).groupBy("stage", "decision").agg(F.count(F.lit(1)).alias("n"))


@query
def alerts(spark, sf_dir):
    return D.alerts(_decided(spark, sf_dir)).select("transaction_id", "account_id", "decision", "rule_hit", "cep_pattern")


@query
def score_threshold(spark, sf_dir):
    return V.transactions(spark, sf_dir).select(
        "transaction_id", P.score_decision(F.col("ml_score"), SCORE_THRESHOLD).alias("decision")
    )


@query
def latest_decision(spark, sf_dir):
    """Latest row per key with hot keys: the last decision of each account."""
    rows = V.decisions(spark, sf_dir)
    return latest_by_key(rows, ["account_id"], ["decided_at", "transaction_id"]).select(
        "account_id", "transaction_id", "decision", _us("decided_at")
    )


# Features

def _features(df: DataFrame, *more: str) -> DataFrame:
    rounded = [F.round(f, 4 if f == "avg_amount_24h" else 6).alias(f) for f in FEATURES]
    return df.select("transaction_id", "account_id", *rounded, *more)


@query
def training_features(spark, sf_dir):
    return _features(features.training_features(V.labelled(spark, sf_dir)))


@query
def serving_features(spark, sf_dir):
    log = V.transactions(spark, sf_dir).withColumn("decision", P.score_decision(F.col("ml_score"), 0.7))
    return _features(features.serving_features(log))


@query
def replay_features(spark, sf_dir):
    return _features(features.replay_features(V.transactions(spark, sf_dir)))


@query
def home_location(spark, sf_dir):
    tx = V.transactions(spark, sf_dir)
    return joins.first_value_by(tx, "account_id", "location_name", ["event_time", "transaction_id"])


# Latency and throughput

def _log(spark, sf_dir) -> DataFrame:
    return reports.report_rows(V.decisions(spark, sf_dir), eq=("ACC_00001",))


@query
def total_transactions(spark, sf_dir):
    return reports.total_transactions(_log(spark, sf_dir))


def _window(spark, sf_dir):
    """The log from the sixth hour of its day up to the twentieth, bounds as in a panel's range."""
    start, end = (datetime.fromtimestamp(V.BASE_US / 1e6 + h * 3600, timezone.utc) for h in (6, 20))
    return reports.report_rows(V.decisions(spark, sf_dir), start=start, end=end)


@query
def total_transactions_window(spark, sf_dir):
    return reports.total_transactions(_window(spark, sf_dir))


@query
def latency_percentiles_window(spark, sf_dir):
    return _round(reports.latency_percentiles(_window(spark, sf_dir)), 4, *reports.PERCENTILES, "max_ms")


@query
def written_decisions(spark, sf_dir):
    """Two runs into one table, the second with part of the first again: read back, the newest row of each."""
    path = shared_dir(spark, "decisions")
    rows = V.decisions(spark, sf_dir).withColumn("amount", F.col("amount").cast("decimal(18,2)")).withColumn("ml_score", F.col("ml_score").cast("float"))
    late = F.unix_micros("produced_at") % 3 == 0
    for run, part in enumerate((~late, late | (F.unix_micros("produced_at") % 3 == 1))):
        write_decisions(rows.filter(part), path, run)
    return read_decisions(spark, path).groupBy("batch_id", "decision").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


@query
def latency_avg(spark, sf_dir):
    return reports.avg_latency(_log(spark, sf_dir))


@query
def latency_percentiles(spark, sf_dir):
    return _round(reports.latency_percentiles(_log(spark, sf_dir)), 4, *reports.PERCENTILES, "max_ms")


@query
def latency_series(spark, sf_dir):
    df = reports.latency_series(_log(spark, sf_dir))
    return _round(df, 4, "p50", "p90", "p99").select(_us("second"), "p50", "p90", "p99", "max_ms")


@query
def throughput_in(spark, sf_dir):
    return reports.throughput(_log(spark, sf_dir), "produced_at").select(_us("second"), "n")


@query
def throughput_out(spark, sf_dir):
    return reports.throughput(_log(spark, sf_dir), "decided_at").select(_us("second"), "n")


@query
def latency_by_level(spark, sf_dir):
    df = reports.latency_by_level(_log(spark, sf_dir), V.load_levels(spark, sf_dir))
    return _round(df, 4, "avg_ms", "p50_ms", "p95_ms", "p99_ms").select(
        "tps", _us("start"), "n", "avg_ms", "p50_ms", "p95_ms", "p99_ms", "max_ms"
    )


@query
def top_slowest(spark, sf_dir):
    return reports.top_slowest(_log(spark, sf_dir))


# Detection quality

def _truth(spark, sf_dir) -> DataFrame:
    return reports.with_truth(_log(spark, sf_dir), V.ground_truth(spark, sf_dir))


@query
def confusion(spark, sf_dir):
    return reports.confusion(_truth(spark, sf_dir))


@query
def detection_rates(spark, sf_dir):
    return _round(reports.detection_rates(_truth(spark, sf_dir)), 6, "detection_rate", "wrong_detection_rate")


@query
def fdr(spark, sf_dir):
    return reports.fdr(_truth(spark, sf_dir))


@query
def fpr(spark, sf_dir):
    return reports.fpr(_truth(spark, sf_dir))


@query
def ml_precision(spark, sf_dir):
    return reports.ml_precision(_truth(spark, sf_dir))


@query
def ml_recall(spark, sf_dir):
    return reports.ml_recall(_truth(spark, sf_dir))


@query
def ml_f1(spark, sf_dir):
    return reports.ml_f1(_truth(spark, sf_dir))


@query
def auc_roc(spark, sf_dir):
    return _round(reports.auc_roc(_truth(spark, sf_dir)), 6, "auc_roc")


@query
def auc_roc_min_rank(spark, sf_dir):
    return _round(reports.auc_roc(_truth(spark, sf_dir), ties="min"), 6, "auc_roc")


@query
def auc_pr(spark, sf_dir):
    return _round(reports.auc_pr(_truth(spark, sf_dir)), 6, "auc_pr")


@query
def auc_pr_by_row(spark, sf_dir):
    return _round(reports.auc_pr(_truth(spark, sf_dir), ties="row"), 6, "auc_pr")


@query
def best_threshold(spark, sf_dir):
    return _round(reports.best_threshold(_truth(spark, sf_dir)), 6, "threshold", "precision", "recall", "f1")


@query
def ranking_report(spark, sf_dir):
    """Areas and best threshold together, from one reading of the rows."""
    df = reports.ranking_report(_truth(spark, sf_dir)).select("*", "best.*").drop("best")
    return _round(df, 6, "auc_roc", "auc_pr", "threshold", "precision", "recall", "f1")


@query
def classification_report(spark, sf_dir):
    df = reports.classification_report(_truth(spark, sf_dir), SCORE_THRESHOLD, MODEL_TARGETS)
    return _round(df, 6, "precision", "recall", "f1")


@query
def error_rows(spark, sf_dir):
    return reports.errors(_truth(spark, sf_dir)).select("transaction_id", "kind")


@query
def missed_by_pattern(spark, sf_dir):
    return reports.missed_by_pattern(_truth(spark, sf_dir))


@query
def missed_account_history(spark, sf_dir):
    """All rows of the accounts in which a fraud was missed."""
    labelled = _truth(spark, sf_dir)
    missed = reports.missed(labelled)
    return joins.members(labelled, missed, "account_id", "transaction_id").select(
        "account_id", "transaction_id", "amount", "decision", "is_fraud", "fraud_pattern"
    )


# Data set

@query
def truth_table(spark, sf_dir):
    """Labelled transactions appended in two runs, read back by label and by whether they may be published."""
    path = shared_dir(spark, "truth")
    rows = V.ground_truth(spark, sf_dir)
    for part in range(2):
        write_ground_truth(rows.filter(F.col("transaction_id").cast("long") % 2 == part), path)
    truth = spark.read.schema(schemas.GROUND_TRUTH).parquet(path)
    kept = truth.groupBy("is_fraud", "fraud_pattern").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    public = drop_labels(truth)
    for name in ("is_fraud", "fraud_pattern"):
        kind = truth.schema[name].dataType
        public = public if name in public.columns else public.withColumn(name, F.lit(None).cast(kind))
    hidden = public.groupBy("is_fraud", "fraud_pattern").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    return kept.unionByName(hidden)


@query
def labelled_report(spark, sf_dir):
    """The training set as CSV in order of account and time, read back by file: ``in_order`` says that a file ends where the
    next begins, and a table that is reset has no rows and the same columns."""
    path = f"{shared_dir(spark, 'report')}.csv"
    names = schemas.LABELLED.fieldNames()
    write_report(V.labelled(spark, sf_dir).select(*names), path, "account_id", "event_time")
    rows = readers.read_labelled(spark, path)
    place = F.struct("account_id", "event_time")
    files = rows.groupBy(F.input_file_name().alias("file")).agg(F.min(place).alias("least"), F.max(place).alias("most"))
    # One row per file here.
    before = F.lag("most").over(Window.orderBy("file"))
    in_order = files.select((before.isNull() | (before <= F.col("least"))).alias("ok")).agg(F.every("ok"))
    emptied = f"{shared_dir(spark, 'reset')}"
    overwrite_table(rows, emptied)
    reset_table(spark, emptied, schemas.LABELLED)
    empty = spark.read.parquet(emptied)
    reset = empty.agg((F.count(F.lit(1)) == 0) & F.lit(empty.columns == names))
    out = rows.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.count_if("is_fraud").alias("fraud"),
        F.count_if("is_home").alias("home"), F.unix_micros(F.max("event_time")).alias("last_us"),
    )
    return out.select("*", in_order.scalar().alias("in_order"), reset.scalar().alias("reset"))


@query
def dataset_profile(spark, sf_dir):
    df = profile.profile(V.labelled(spark, sf_dir))
    df = _round(df, 4, "fraud_percent", "amount_mean", "q25", "q50", "q75")
    return df.withColumn("amount_std", F.round("amount_std", 2)).select(
        "total_rows", "fraud_rows", "fraud_percent", "accounts", _us("first_event"), _us("last_event"), "amount_count",
        "amount_mean", "amount_std", "amount_min", "q25", "q50", "q75", "amount_max",
    )


@query
def dataset_union(spark, sf_dir):
    """Normal and fraudulent rows put together in order of time."""
    rows = V.labelled(spark, sf_dir)
    both = profile.combine(rows.filter(~F.col("is_fraud")), rows.filter("is_fraud"))
    return both.select("transaction_id", "account_id", "amount", _us("event_time"), P.label_name().alias("label"))


@query
def hour_histogram(spark, sf_dir):
    return profile.hour_histogram(V.labelled(spark, sf_dir))


@query
def amount_box(spark, sf_dir):
    return _round(profile.amount_box(V.labelled(spark, sf_dir)), 4, "low", "q25", "q50", "q75", "high")


@query
def fraud_by_location(spark, sf_dir):
    return profile.fraud_by_location(V.labelled(spark, sf_dir))


@query
def account_mean(spark, sf_dir):
    return _round(profile.account_mean(V.labelled(spark, sf_dir)), 4, "mean_amount")


@query
def class_weight(spark, sf_dir):
    return profile.class_weight(V.labelled(spark, sf_dir))


@query
def account_mismatch(spark, sf_dir):
    """Transactions against the accounts table, which is written and read; one in 50 comes without an account."""
    path = shared_dir(spark, "accounts")
    overwrite_table(V.accounts(spark, sf_dir), path)
    tx = V.transactions(spark, sf_dir)
    tx = tx.withColumn("account_id", F.when(F.col("transaction_id").cast("long") % 50 != 7, F.col("account_id")))
    return profile.account_mismatch(tx, readers.read_accounts(spark, path))


@query
def account_split(spark, sf_dir):
    return profile.account_split(V.labelled(spark, sf_dir))


@query
def split_rows(spark, sf_dir):
    """Rows and fraud per part, with every row meeting its account's part."""
    rows = V.labelled(spark, sf_dir)
    return profile.with_part(rows, profile.account_split(rows)).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_fraud").alias("fraud")
    )


# Messages

@query
def parse_valid(spark, sf_dir):
    good, _ = parsing.split_dlq(parsing.parse_transactions(V.messages(spark, sf_dir)))
    return good.select(
        "offset", "transaction_id", _us("produced_at"), _us("event_time"), "account_id", "card_id", "amount", "channel",
        "location_name", "status",
    )


@query
def dlq_records(spark, sf_dir):
    _, bad = parsing.split_dlq(parsing.parse_transactions(V.messages(spark, sf_dir)))
    return parsing.dlq_records(bad, F.lit("2026-01-01 00:00:00").cast("timestamp"))


@query
def source_reads(spark, sf_dir):
    """Messages written as text and with their envelope, read back as transactions: how many are good, by source."""
    path = shared_dir(spark, "messages")
    messages = V.messages(spark, sf_dir)
    messages.select("value").write.text(f"{path}/text")
    for fmt in ("json", "parquet"):
        messages.write.format(fmt).save(f"{path}/{fmt}")
    counts = []
    for fmt in ("text", "json", "parquet"):
        parsed = parsing.parse_transactions(readers.read_transactions(spark, fmt, f"{path}/{fmt}", streaming=False))
        counts.append(parsed.groupBy("topic", "partition", (F.size("errors") == 0).alias("good")).agg(
            F.lit(fmt).alias("source"), F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.sum("offset").alias("offsets")
        ))
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def parse_rules(spark, sf_dir):
    parsed = parsing.with_error_message(parsing.parse_rules(V.rule_messages(spark, sf_dir)))
    return parsed.select(
        "offset", "error_message", "rule_id", "field", "operator", "threshold", F.col("value").alias("operand"), "action", "enabled"
    )


# Model

def _risk(rows: np.ndarray) -> np.ndarray:
    """A fixed stand-in for a model, so that results can be checked: busier and larger than usual is riskier."""
    ratio, busy = (rows[:, FEATURES.index(f)] for f in ("log_amount_ratio_24h", "tx_count_1h"))
    return np.floor((ratio / (1 + ratio) + np.minimum(busy, 9.0) / 100) * 1e6 + 0.5) / 1e6


@query
def sequential_serving_fold(spark, sf_dir):
    """Features that depend on the decisions they lead to."""
    staged = V.transactions(spark, sf_dir).drop("ml_score").withColumn(
        "stage", F.when(F.col("amount") > 1_000_000_000, "RULE").otherwise("ML")
    )
    return _features(serve_in_order(staged, _risk, 0.6), "ml_score", "approved")


@query
def decide_full(spark, sf_dir):
    """From rows to decisions by way of all stages: rules, allow-list, patterns, features over all rows, the model."""
    active = rules.active_rules(V.rule_updates(spark, sf_dir))
    decided = D.decide(V.transactions(spark, sf_dir).drop("ml_score"), active, CONFIG, PRIORITY, 0.6, _risk)
    decided = decided.withColumn("amount", F.col("amount").cast("double"))
    return _features(decided, "rule_hit", "cep_pattern", "stage", "ml_score", "decision")


@query
def model_scores(spark, sf_dir):
    """Scores of the test accounts by a model fitted on the training accounts."""
    rows = features.training_features(V.labelled(spark, sf_dir))
    rows = profile.with_part(rows, profile.account_split(rows))
    model = ml.train(rows.filter("part = 'train'"), ml.Params(depth=3, rounds=8))
    return ml.score(model, rows.filter("part = 'test'")).select("transaction_id", "is_fraud", F.round("ml_score", 6).alias("ml_score"))


@query
def model_checked(spark, sf_dir):
    """What is determined of a fitted model: the test rows with their assembled features and the class weight, that a saved
    model gives the same scores when read again, that its trees as arrays do too, and that it ranks better than chance."""
    path = shared_dir(spark, "model")
    rows = features.training_features(V.labelled(spark, sf_dir))
    rows = profile.with_part(rows, profile.account_split(rows))
    fitted, held = rows.filter("part = 'train'"), rows.filter("part = 'test'")
    model = ml.train(fitted, ml.Params(depth=3, rounds=8))
    ml.save_model(model, f"{path}/model")
    trees = ml.trees_of(model)
    by_trees = F.pandas_udf(lambda *c: pd.Series(trees.scores(np.column_stack(c))), "double")
    both = ml.score(ml.load_model(f"{path}/model"), ml.score(model, held), "again").withColumn("by_trees", by_trees(*FEATURES))
    overwrite_table(both, f"{path}/scores")
    both = spark.read.parquet(f"{path}/scores")
    area = reports.auc_roc(both).first().auc_roc
    weight = profile.class_weight(fitted).first().class_weight
    return _features(
        both, "is_fraud", F.lit(weight).alias("class_weight"), (F.col("ml_score") == F.col("again")).alias("same_again"),
        (F.abs(F.col("ml_score") - F.col("by_trees")) < 1e-12).alias("same_by_trees"), F.lit(area > 0.5).alias("ranks"),
    )


@query
def early_stopping(spark, sf_dir):
    """The round kept after boosting with patience, held against its rule: its precision is the best up to ``patience``
    rounds further on, and the model fitted up to there has it."""
    rows = features.training_features(V.labelled(spark, sf_dir))
    rows = profile.with_part(rows, profile.account_split(rows))
    path = shared_dir(spark, "parts")
    overwrite_table(rows, path)
    rows = spark.read.parquet(path)
    held = rows.filter("part = 'test'")
    model, precision = ml.train_patiently(rows.filter("part = 'train'"), held, ml.Params(depth=3, rounds=12), patience=4)
    kept = model.stages[-1].getNumTrees
    again = reports.auc_pr(ml.score(model, held)).first().auc_pr
    first_best = precision[kept - 1] == max(precision[: kept + 4]) and precision[kept - 1] > max([0.0, *precision[: kept - 1]])
    return spark.range(1).select(
        F.lit(len(precision)).alias("rounds"), F.lit(first_best).alias("best_in_reach"),
        F.lit(bool(abs(again - precision[kept - 1]) < 1e-9)).alias("same_precision"),
    )


# Streams

def _in_batches(spark, rows, part, run, parts: int = 4) -> str:
    """Writes the rows part by part; after each, ``run(stream, folder)`` takes in what is new."""
    folder = shared_dir(spark, "stream")
    for i in range(parts):
        rows.filter(part == i).write.mode("append").parquet(f"{folder}/in")
        started = run(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), folder)
        started.awaitTermination()
        if started.exception() is not None:
            raise started.exception()
    return folder


def _by_time(spark, sf_dir, run, parts: int = 4) -> str:
    """Transactions in spans of event time."""
    width = V.SPAN_US // parts
    part = F.floor((F.unix_micros("event_time") - V.BASE_US) / width)
    # What is earlier or later than expected, or has no time, still goes into a part.
    part = F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.coalesce(part, F.lit(0))))
    return _in_batches(spark, V.transactions(spark, sf_dir), part, run, parts)


@query
def decide_stream(spark, sf_dir):
    updates = V.rule_updates(spark, sf_dir)

    def run(stream, folder):
        decider = jobs.Decider(jobs.DecisionLog(f"{folder}/out"), lambda: updates, CONFIG, PRIORITY)
        return jobs.decide_stream(stream, decider, f"{folder}/checkpoint", availableNow=True)

    folder = _by_time(spark, sf_dir, run)
    return jobs.DecisionLog(f"{folder}/out").read(spark).select(
        "transaction_id", "account_id", F.col("amount").cast("long").alias("amount"), "rule_hit", "cep_pattern",
        F.round(F.col("ml_score").cast("double"), 4).alias("ml_score"), _us("produced_at"), _us("decided_at"), "decision",
    )


@query
def decide_stream_compacted(spark, sf_dir):
    """The same decisions from batches whose folders are merged after every second one."""
    updates = V.rule_updates(spark, sf_dir)

    def run(stream, folder):
        decider = jobs.Decider(jobs.DecisionLog(f"{folder}/out"), lambda: updates, CONFIG, PRIORITY, compact_every=2)
        return jobs.decide_stream(stream, decider, f"{folder}/checkpoint", availableNow=True)

    folder = _by_time(spark, sf_dir, run)
    return jobs.DecisionLog(f"{folder}/out").read(spark).select("transaction_id", "account_id", "rule_hit", "cep_pattern", "decision")


@query
def decide_stream_scored(spark, sf_dir):
    """Decisions of a stream whose rows are scored as they come; the same as those of one batch over all rows."""
    updates = V.rule_updates(spark, sf_dir)

    def run(stream, folder):
        decider = jobs.Decider(jobs.DecisionLog(f"{folder}/out"), lambda: updates, CONFIG, PRIORITY, 0.6, _risk)
        return jobs.decide_stream(stream.drop("ml_score"), decider, f"{folder}/checkpoint", availableNow=True)

    folder = _by_time(spark, sf_dir, run)
    return jobs.DecisionLog(f"{folder}/out").read(spark).select(
        "transaction_id", "account_id", "rule_hit", "cep_pattern", F.round(F.col("ml_score").cast("double"), 4).alias("ml_score"), "decision"
    )


@query
def decide_stream_late(spark, sf_dir):
    """Late rows and replays: all rows but each tenth come first; then the late ones, twice, and a tenth of the others again
    with another score. Late rows are decided among all that came; what was decided stays, and is decided once."""
    updates = V.rule_updates(spark, sf_dir)
    rows, last = V.transactions(spark, sf_dir), F.col("transaction_id").cast("long") % 10
    late, again = rows.filter(last == 3), rows.filter(last == 4).withColumn("ml_score", F.lit(0.99))
    second = late.unionByName(late).unionByName(again).withColumn("_part", F.lit(1))
    both = rows.filter(last != 3).withColumn("_part", F.lit(0)).unionByName(second)

    def run(stream, folder):
        decider = jobs.Decider(jobs.DecisionLog(f"{folder}/out"), lambda: updates, CONFIG, PRIORITY)
        return jobs.decide_stream(stream.drop("_part"), decider, f"{folder}/checkpoint", availableNow=True)

    folder = _in_batches(spark, both, F.col("_part"), run, 2)
    return jobs.DecisionLog(f"{folder}/out").read(spark).select(
        "transaction_id", "account_id", "rule_hit", "cep_pattern", F.round(F.col("ml_score").cast("double"), 4).alias("ml_score"), "decision"
    )


@query
def decide_stream_rules(spark, sf_dir):
    """Rules that change while transactions flow: before each quarter of the time, the updates sent until then come in as
    messages; the quarter is decided by the rules then in force."""
    fields = schemas.RULE.fieldNames()
    updates = V.rule_updates(spark, sf_dir).select(
        F.to_json(F.struct(*fields)).alias("value"), F.lit("rules-updates").alias("topic"), F.lit(0).alias("partition"),
        F.col("seq").alias("offset"), "updated_at",
    )
    sent, parts = shared_dir(spark, "sent"), iter(range(4))
    width = V.SPAN_US // 4

    def run(stream, folder):
        part = next(parts)
        since, until = (F.timestamp_micros(F.lit(V.BASE_US + p * width)) for p in (part - 1, part))
        new = updates.filter((F.col("updated_at") < until) & (F.col("updated_at") >= since))
        new.drop("updated_at").write.mode("append").parquet(sent)
        incoming = readers.read_rule_updates(spark, "parquet", sent).drop("seq")
        jobs.rule_stream(incoming, f"{folder}/rules", f"{folder}/dlq", f"{folder}/rules-checkpoint", availableNow=True).awaitTermination()
        decider = jobs.Decider(
            jobs.DecisionLog(f"{folder}/out"), lambda: jobs.read_rule_table(spark, f"{folder}/rules"), CONFIG, PRIORITY
        )
        return jobs.decide_stream(stream, decider, f"{folder}/checkpoint", availableNow=True)

    folder = _by_time(spark, sf_dir, run)
    return jobs.DecisionLog(f"{folder}/out").rows.read(spark).select("transaction_id", "account_id", "rule_hit", "rule_status")


@query
def cep_stream(spark, sf_dir):
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )

    def run(stream, folder):
        return stateful.cep_stream(stream, CONFIG).writeStream.foreachBatch(
            lambda batch, batch_id: write_batch(batch, f"{folder}/out", batch_id)
        ).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()

    folder = _by_time(spark, sf_dir, run)
    return spark.read.schema(stateful.OUTPUT).parquet(f"{folder}/out").select("transaction_id", "cep_pattern")


def _metrics(spark, sf_dir) -> DataFrame:
    """Finished seconds of the transactions' stream. A heartbeat a minute after all rows lets the last seconds finish."""
    rows = V.transactions(spark, sf_dir).select("decided_at", "produced_at", "event_time")
    beat = rows.agg(F.max("decided_at").alias("t")).select(F.timestamp_add("MINUTE", F.lit(1), "t").alias("decided_at"))
    beat = beat.select("decided_at", F.col("decided_at").alias("produced_at"), F.lit(None).cast("timestamp").alias("event_time"))
    span = F.floor((F.unix_micros("event_time") - V.BASE_US) / (V.SPAN_US // 4))
    part = F.coalesce(F.greatest(F.lit(0), F.least(F.lit(3), span)), F.lit(4))

    def run(stream, folder):
        return jobs.write_metrics(jobs.metrics_stream(stream), f"{folder}/out", f"{folder}/checkpoint", availableNow=True)

    folder = _in_batches(spark, rows.unionByName(beat), part, run, 5)
    return spark.read.parquet(f"{folder}/out")


@query
def cep_state_left(spark, sf_dir):
    """Accounts that the pattern stream still has state for once all rows have come: those whose newest row some later row
    could look back at. Idle ones have lost theirs; what came out is the same as without an end of state."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )

    def run(stream, folder):
        return stateful.cep_stream(stream, CONFIG, late="10 minutes").writeStream.foreachBatch(
            lambda batch, batch_id: write_batch(batch, f"{folder}/out", batch_id)
        ).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()

    folder = _by_time(spark, sf_dir, run)
    left = stateful.stored_accounts(spark, f"{folder}/checkpoint").withColumn("left", F.lit(True))
    found = spark.read.schema(stateful.OUTPUT).parquet(f"{folder}/out").groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("cep_pattern").alias("patterns")
    )
    return found.join(left, "account_id", "left").select("account_id", "n", "patterns", F.coalesce("left", F.lit(False)).alias("left"))


@query
def metrics_stream(spark, sf_dir):
    return jobs.with_quantiles(_metrics(spark, sf_dir)).select(_us("second"), "n", "p50", "p90", "p99", "max_ms")


@query
def metrics_by_hour(spark, sf_dir):
    """Hours added up from the seconds of the stream; percentiles are checked for the hours that their sketch holds whole."""
    hours = jobs.with_quantiles(jobs.metric_spans(_metrics(spark, sf_dir), "hour"))
    exact = [F.when(F.col("n") <= jobs.SKETCH_K // 2, F.col(p)).alias(p) for p in jobs.METRIC_QUANTILES]
    return hours.select(_us("hour"), "n", *exact, "max_ms")


@query
def dlq_stream(spark, sf_dir):
    """Dead letters of a message stream whose good messages are decided."""
    def run(stream, folder):
        decider = jobs.Decider(jobs.DecisionLog(f"{folder}/out"), lambda: V.rule_updates(spark, sf_dir), CONFIG, PRIORITY)
        return jobs.decide_messages(stream, decider, f"{folder}/dlq", f"{folder}/checkpoint", availableNow=True)

    messages = V.messages(spark, sf_dir)
    folder = _in_batches(spark, messages, F.pmod(F.xxhash64("offset"), F.lit(2)), run, 2)
    letter = F.from_json("value", "sourceTopic STRING, partition INT, `offset` BIGINT, rawPayload STRING, errorMessage STRING")
    letters = spark.read.text(f"{folder}/dlq").select(letter.alias("l")).select("l.*")
    # What was not dead must have been decided.
    decided = jobs.DecisionLog(f"{folder}/out").read(spark).agg(F.count(F.lit(1)).alias("decided"))
    return letters.groupBy("errorMessage").agg(F.count(F.lit(1)).alias("n"), F.sum("offset").alias("offsets")).unionByName(
        decided.select(F.lit("").alias("errorMessage"), F.col("decided").alias("n"), F.lit(None).cast("long").alias("offsets"))
    )


@query
def rule_stream(spark, sf_dir):
    """Rules in force after all updates have come in as messages."""
    def run(stream, folder):
        return jobs.rule_stream(stream, f"{folder}/rules", f"{folder}/dlq", f"{folder}/checkpoint", availableNow=True)

    messages = V.rule_messages(spark, sf_dir)
    folder = _in_batches(spark, messages, F.pmod(F.xxhash64("offset"), F.lit(2)), run, 2)
    return rules.active_rules(jobs.read_rule_table(spark, f"{folder}/rules")).select(
        "rule_id", "field", "operator", "threshold", F.col("value").alias("operand"), "action", "seq"
    )


@query
def rule_dead_letters(spark, sf_dir):
    """Dead letters of rule messages, sent on as JSON by a stream of their own."""
    def run(stream, folder):
        _, bad = parsing.split_dlq(parsing.parse_rules(stream))
        return write_dlq_stream(parsing.dlq_records(bad), "text", f"{folder}/checkpoint", {"availableNow": True}, path=f"{folder}/dlq")

    folder = _in_batches(spark, V.rule_messages(spark, sf_dir), F.pmod(F.xxhash64("offset"), F.lit(2)), run, 2)
    letter = F.from_json("value", "sourceTopic STRING, partition INT, `offset` BIGINT, rawPayload STRING, errorMessage STRING")
    return spark.read.text(f"{folder}/dlq").select(letter.alias("l")).select("l.*")

"""Latency, throughput and detection reports over decisions and ground truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.constants import APPROVED, RULE_TEST_ACCOUNTS_LIKE
from riskengine.functions.predicates import exclude_accounts, with_trigger
from riskengine.functions.time import time_range, with_latency
from riskengine.operators.joins import interval_join, salted_join
from riskengine.operators.prefix import exact_quantiles, hashed_rank, prefix_sums
from riskengine.operators.steps import find_step
from riskengine.session import stored

PERCENTILES = {"p50_ms": 0.50, "p90_ms": 0.90, "p95_ms": 0.95, "p99_ms": 0.99}


def report_rows(
    df: DataFrame, start=None, end=None, col: str = "produced_at", like: str | None = RULE_TEST_ACCOUNTS_LIKE, eq: Sequence[str] = ()
) -> DataFrame:
    """The rows a report covers: test accounts out, one time window."""
    return time_range(exclude_accounts(df, like, eq), col, start, end)


# Latency and throughput

def total_transactions(decisions: DataFrame) -> DataFrame:
    return decisions.agg(F.count(F.lit(1)).alias("total"))


def _mean(col: str) -> Column:
    """Integer mean from an exact sum, the same whatever the order of the rows."""
    return F.sum(col).cast("double") / F.count(col)


def avg_latency(decisions: DataFrame) -> DataFrame:
    return with_latency(decisions).agg(F.round(_mean("latency_ms"), 0).alias("avg_latency_ms"))


def latency_percentiles(decisions: DataFrame, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Exact, interpolated percentiles and the maximum."""
    quantiles = {**PERCENTILES, "max_ms": 1.0}
    return exact_quantiles(with_latency(decisions), "latency_ms", quantiles, rows_per_bucket=rows_per_bucket)


def throughput(decisions: DataFrame, col: str) -> DataFrame:
    second = F.date_trunc("second", col).alias("second")
    return decisions.groupBy(second).agg(F.count(F.lit(1)).alias("n")).orderBy("second")


def latency_series(decisions: DataFrame, col: str = "decided_at") -> DataFrame:
    """Latency percentiles per second. Equal latencies of a second are counted before the shuffle."""
    counts = (
        with_latency(decisions)
        .groupBy(F.date_trunc("second", col).alias("second"), "latency_ms")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    p = F.percentile("latency_ms", [0.5, 0.9, 0.99], F.col("n"))
    return (
        counts.groupBy("second")
        .agg(p.alias("p"), F.max("latency_ms").alias("max_ms"))
        .select("second", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p90"), F.col("p")[2].alias("p99"), "max_ms")
        .orderBy("second")
    )


def latency_by_level(decisions: DataFrame, levels: DataFrame, bucket_us: int = 60_000_000) -> DataFrame:
    """Latency per load level; a level without traffic has count 0 and null figures."""
    key = ["tps", "start"]
    points = with_latency(decisions).select("transaction_id", "produced_at", "latency_ms")
    met = interval_join(points, levels, "produced_at", "start", "end", bucket_us, "transaction_id")
    counts = met.groupBy(*key, "latency_ms").agg(F.count(F.lit(1)).alias("n"))
    p = F.percentile("latency_ms", [0.5, 0.95, 0.99], F.col("n"))
    stats = counts.groupBy(*key).agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("latency_ms") * F.col("n")).cast("double") / F.sum("n")).alias("avg_ms"),
        p.alias("p"),
        F.max("latency_ms").alias("max_ms"),
    )
    return (
        levels.select(*key)
        .join(stats, key, "left")
        .select(
            *key,
            F.coalesce("n", F.lit(0)).alias("n"),
            "avg_ms",
            F.col("p")[0].alias("p50_ms"),
            F.col("p")[1].alias("p95_ms"),
            F.col("p")[2].alias("p99_ms"),
            "max_ms",
        )
    )


def top_slowest(decisions: DataFrame, n: int = 20) -> DataFrame:
    return (
        with_trigger(with_latency(decisions))
        .select("transaction_id", "account_id", "decision", "trigger", "latency_ms")
        .orderBy(F.desc("latency_ms"), "transaction_id")
        .limit(n)
    )


def rule_propagation_latency(rules: DataFrame, decisions: DataFrame) -> DataFrame:
    """From sending an account rule to the first BLOCK of a transaction produced after it.

    ``rules`` has rule_id, account_id and sent_at. Rules that never blocked are left out. A block is matched only to
    the latest sending before it; the least over the later sendings is then taken among the rules alone.
    """
    blocks = decisions.filter("decision = 'BLOCK'").select("transaction_id", "account_id", "produced_at", "decided_at")
    sent = rules.select("account_id", "sent_at", F.unix_micros("sent_at").alias("lo")).distinct()
    following = F.lead("lo").over(Window.partitionBy("account_id").orderBy("lo"))
    sendings = stored(sent.withColumn("hi", following), "sendings")
    firsts = (
        find_step(blocks.withColumn("_at", F.unix_micros("produced_at")), sendings, "_at", ["sent_at"], "transaction_id", ["account_id"])
        .filter(F.col("sent_at").isNotNull())
        .groupBy("account_id", "sent_at")
        .agg(F.min("decided_at").alias("_first"))
    )
    later = Window.partitionBy("account_id").orderBy(F.desc("sent_at"))
    return (
        rules.join(firsts, ["account_id", "sent_at"], "left")
        .withColumn("first_block", F.min("_first").over(later))
        .filter(F.col("first_block").isNotNull())
        .drop("_first")
        .withColumn("latency_ms", F.unix_millis("first_block") - F.unix_millis("sent_at"))
    )


def mean_propagation(propagation: DataFrame) -> DataFrame:
    return propagation.agg(_mean("latency_ms").alias("mean_latency_ms"), F.count(F.lit(1)).alias("runs"))


# Detection quality

def with_truth(decisions: DataFrame, truth: DataFrame) -> DataFrame:
    """Decisions with their label. Both sides must hold one row per transaction, as ``latest_by_key`` leaves them."""
    return decisions.join(truth.select("transaction_id", "is_fraud", "fraud_pattern"), "transaction_id")


def _caught() -> Column:
    return F.col("decision") != APPROVED


def _alerted() -> Column:
    return F.col("decision") == "ALERT"


def _rate(part: Column, whole: Column) -> Column:
    return part * 100.0 / F.nullif(whole, F.lit(0))


def confusion(labelled: DataFrame) -> DataFrame:
    fraud, caught = F.col("is_fraud"), _caught()
    return labelled.agg(
        F.count_if(fraud & ~caught).alias("false_negative"),
        F.count_if(fraud & caught).alias("true_positive"),
        F.count_if(~fraud & caught).alias("false_positive"),
        F.count_if(fraud).alias("total_fraud"),
        F.count_if(~fraud).alias("total_normal"),
    )


def detection_rates(labelled: DataFrame) -> DataFrame:
    """Shares caught among the fraudulent and among the normal; 0 where there is none."""
    c = confusion(labelled)
    return c.select(
        F.when(F.col("total_fraud") > 0, F.col("true_positive") / F.col("total_fraud")).otherwise(0.0).alias("detection_rate"),
        F.when(F.col("total_normal") > 0, F.col("false_positive") / F.col("total_normal")).otherwise(0.0).alias("wrong_detection_rate"),
    )


def fdr(labelled: DataFrame) -> DataFrame:
    rate = _rate(F.count_if(_caught() & F.col("is_fraud")), F.count_if("is_fraud"))
    return labelled.agg(F.round(rate, 2).alias("fdr"))


def fpr(labelled: DataFrame) -> DataFrame:
    rate = _rate(F.count_if(_caught() & ~F.col("is_fraud")), F.count_if(~F.col("is_fraud")))
    return labelled.agg(F.round(rate, 2).alias("fpr"))


def scored(labelled: DataFrame) -> DataFrame:
    """Only the rows the model decided."""
    return labelled.filter(F.col("ml_score").isNotNull())


def _ml_rates(labelled: DataFrame) -> DataFrame:
    hit = F.count_if(_alerted() & F.col("is_fraud"))
    return scored(labelled).agg(
        _rate(hit, F.count_if(_alerted())).alias("p"), _rate(hit, F.count_if("is_fraud")).alias("r")
    )


def ml_precision(labelled: DataFrame) -> DataFrame:
    return _ml_rates(labelled).select(F.round("p", 2).alias("ml_precision"))


def ml_recall(labelled: DataFrame) -> DataFrame:
    return _ml_rates(labelled).select(F.round("r", 2).alias("ml_recall"))


def ml_f1(labelled: DataFrame) -> DataFrame:
    p, r = F.col("p"), F.col("r")
    return _ml_rates(labelled).select(F.round(2 * p * r / F.nullif(p + r, F.lit(0.0)), 2).alias("ml_f1"))


# Ranking quality

def score_counts(labelled: DataFrame, score: str = "ml_score") -> DataFrame:
    """Positives and negatives per distinct score, written once: the rows are read here and nowhere else. Every figure that
    takes labelled rows takes this table as well, so several figures of the same rows read them once together."""
    if labelled.columns == ["score", "pos", "neg"]:
        return labelled
    counts = labelled.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if("is_fraud").alias("pos"), F.count_if(~F.col("is_fraud")).alias("neg")
    )
    return stored(counts, "score-counts")


def _from_best(labelled: DataFrame, score: str, rows_per_bucket: int) -> DataFrame:
    """Distinct scores with positives and rows, and those of all higher scores."""
    by_score = score_counts(labelled, score).withColumn("n", F.col("pos") + F.col("neg"))
    return prefix_sums(by_score, "score", ["pos", "n"], descending=True, rows_per_bucket=rows_per_bucket)


def auc_roc(labelled: DataFrame, score: str = "ml_score", ties: str = "mid", rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Rank-sum AUC. Tied pairs count half (``mid``), or not at all, as with plain ``rank()`` (``min``)."""
    ranked = prefix_sums(score_counts(labelled, score), "score", ["neg"], rows_per_bucket=rows_per_bucket)
    below = F.col("neg_before").cast("double")
    if ties == "mid":
        won = F.col("pos") * (below + F.col("neg") / 2)
    else:
        # rank() of a tie is 1 + all rows below; n positives of one tie lose n * (n - 1) / 2 against distinct ranks.
        won = F.col("pos") * below - F.col("pos") * (F.col("pos") - 1) / 2
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg((F.sum(won) / F.nullif(pairs, F.lit(0.0))).alias("auc_roc"))


def auc_pr(labelled: DataFrame, score: str = "ml_score", ties: str = "score", rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Average precision over distinct scores, or row by row with ties in md5(transaction_id) order (``row``)."""
    if ties == "score":
        precision = (F.col("pos_before") + F.col("pos")) / (F.col("n_before") + F.col("n"))
        ranked = _from_best(labelled, score, rows_per_bucket)
        return ranked.agg((F.sum(F.col("pos") * precision) / F.nullif(F.sum("pos"), F.lit(0))).alias("auc_pr"))
    rows = stored(
        labelled.filter(F.col(score).isNotNull()).select("transaction_id", F.col(score).alias("score"), "is_fraud"), "scored-rows"
    )
    ranked = _from_best(rows, "score", rows_per_bucket)
    rows = rows.withColumn("tp", F.col("is_fraud").cast("long"))
    placed = hashed_rank(rows, ["score"], "transaction_id", measures=["tp"]).filter("tp = 1")
    starts = ranked.filter("pos > 0").select("score", "pos_before", "n_before")
    placed = salted_join(placed, starts, "score", "inner", "transaction_id")
    precision = (F.col("pos_before") + F.col("tp_upto")) / (F.col("n_before") + F.col("rank"))
    return placed.agg((F.sum(precision) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("auc_pr"))


def pr_curve(labelled: DataFrame, score: str = "ml_score", rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Precision, recall and F1 with each distinct score as the threshold."""
    ranked = _from_best(labelled, score, rows_per_bucket)
    tp = F.col("pos_before") + F.col("pos")
    p, r = F.col("precision"), F.col("recall")
    return (
        ranked.withColumn("precision", tp / (F.col("n_before") + F.col("n")))
        .withColumn("recall", tp / F.col("pos_total"))
        .withColumn("f1", 2 * p * r / (p + r + F.lit(1e-8)))
        .select(F.col("score").alias("threshold"), "precision", "recall", "f1")
    )


def best_threshold(labelled: DataFrame, score: str = "ml_score", rows_per_bucket: int = 1_000_000) -> DataFrame:
    """The threshold of the greatest F1, the lowest such."""
    curve = pr_curve(labelled, score, rows_per_bucket)
    best = F.max_by(F.struct("threshold", "precision", "recall", "f1"), F.struct("f1", -F.col("threshold")))
    return curve.agg(best.alias("best")).select("best.*")


def ranking_report(labelled: DataFrame, score: str = "ml_score", rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Both areas and the best threshold in one row, from one reading of the rows."""
    counts = score_counts(labelled, score)
    figures = [auc_roc(counts, rows_per_bucket=rows_per_bucket), auc_pr(counts, rows_per_bucket=rows_per_bucket)]
    best = best_threshold(counts, rows_per_bucket=rows_per_bucket)
    size = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return size.select("*", *[f.scalar().alias(f.columns[0]) for f in figures], best.select(F.struct("*")).scalar().alias("best"))


def classification_report(
    labelled: DataFrame, threshold: float, targets: dict[str, float], score: str = "ml_score"
) -> DataFrame:
    """Precision, recall and F1 at a threshold, each with whether it beats its target."""
    predicted = F.col(score) >= F.lit(threshold)
    counts = labelled.filter(F.col(score).isNotNull()).agg(
        F.count_if(predicted & F.col("is_fraud")).alias("tp"),
        F.count_if(predicted).alias("predicted"),
        F.count_if("is_fraud").alias("actual"),
    )
    precision = F.coalesce(F.try_divide("tp", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", "actual"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("predicted") + F.col("actual")), F.lit(0.0))
    out = counts.select(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))
    return out.select("*", *[(F.col(m) > targets[m]).alias(f"{m}_ok") for m in ("precision", "recall", "f1")])


def errors(labelled: DataFrame) -> DataFrame:
    """The wrongly decided rows, with ``kind``: missed fraud (``fn``) or false alarm (``fp``)."""
    wrong = F.col("is_fraud") != _caught()
    return labelled.filter(wrong).withColumn("kind", F.when(F.col("is_fraud"), "fn").otherwise("fp"))


def missed(labelled: DataFrame) -> DataFrame:
    return labelled.filter(F.col("is_fraud") & ~_caught())


def missed_by_pattern(labelled: DataFrame) -> DataFrame:
    return (
        missed(labelled).groupBy("fraud_pattern").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "fraud_pattern")
    )

"""One decision per transaction: rules, then the allow-list, then the patterns, then the score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.constants import APPROVED, PRIORITY_ACCOUNTS, SCORE_THRESHOLD
from riskengine.functions.predicates import score_decision
from riskengine.operators.cep import CepConfig, cep_decide, pattern_status
from riskengine.operators.feedback import Scorer, serve_in_order
from riskengine.operators.rules import apply_rules

RULE, PRIORITY, CEP, ML = "RULE", "PRIORITY", "CEP", "ML"


def stage_of(priority_accounts: Sequence[str] = PRIORITY_ACCOUNTS) -> Column:
    """Which stage decides a row that carries ``rule_hit`` and ``cep_pattern``."""
    return (
        F.when(F.col("rule_hit").isNotNull(), RULE)
        .when(F.col("account_id").isin(*priority_accounts), PRIORITY)
        .when(F.col("cep_pattern").isNotNull(), CEP)
        .otherwise(ML)
    )


def reaches_patterns(priority_accounts: Sequence[str] = PRIORITY_ACCOUNTS) -> Column:
    return F.col("rule_hit").isNull() & ~F.col("account_id").isin(*priority_accounts)


def stages(
    ruled: DataFrame, config: CepConfig = CepConfig(), priority_accounts: Sequence[str] = PRIORITY_ACCOUNTS
) -> DataFrame:
    """Adds ``cep_pattern`` and ``stage`` to rows that already carry ``rule_hit`` and ``rule_status``."""
    return cep_decide(ruled, config, reaches_patterns(priority_accounts)).withColumn(
        "stage", stage_of(priority_accounts)
    )


def conclude(
    staged: DataFrame, config: CepConfig = CepConfig(), threshold: float = SCORE_THRESHOLD
) -> DataFrame:
    """Adds ``decision`` and keeps ``ml_score`` only where the score decided."""
    scored = F.when(F.col("stage") == ML, F.col("ml_score"))
    decision = (
        F.when(F.col("stage") == RULE, F.col("rule_status"))
        .when(F.col("stage") == PRIORITY, APPROVED)
        .when(F.col("stage") == CEP, pattern_status(config))
        .otherwise(score_decision(F.col("ml_score"), threshold))
    )
    return staged.withColumn("decision", decision).withColumn("ml_score", scored)


def decide(
    tx: DataFrame,
    rules: DataFrame,
    config: CepConfig = CepConfig(),
    priority_accounts: Sequence[str] = PRIORITY_ACCOUNTS,
    threshold: float = SCORE_THRESHOLD,
    score: Scorer | None = None,
) -> DataFrame:
    """Adds ``rule_hit``, ``cep_pattern``, ``stage``, ``ml_score`` and ``decision``.

    The rule lookup and the conclusion are narrow; the patterns need the one exchange. ``score`` gives a score from the
    nine features, which look back over all rows, whatever stage decided them, and average the approved ones; the result
    then carries the features too. Without it the rows bring their ``ml_score``.
    """
    staged = stages(apply_rules(tx, rules), config, priority_accounts)
    if score is not None:
        # The feature is a double of the same name; a decision has the whole amount.
        served = serve_in_order(staged.withColumn("_tx_amount", F.col("amount")), score, threshold)
        staged = served.withColumn("amount", F.col("_tx_amount")).drop("_tx_amount")
    return conclude(staged, config, threshold)


def to_decision(df: DataFrame, decided_at: Column | None = None) -> DataFrame:
    """The decision table's columns. The stamp is the wall clock unless given, as a replay must."""
    return df.select(
        "transaction_id",
        "account_id",
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        "rule_hit",
        "cep_pattern",
        F.col("ml_score").cast("float").alias("ml_score"),
        "produced_at",
        (F.current_timestamp() if decided_at is None else decided_at).alias("decided_at"),
        "decision",
    )


def alerts(decisions: DataFrame) -> DataFrame:
    return decisions.filter(F.col("decision") != APPROVED)

"""Row predicates and derived columns. All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.constants import ALERT, APPROVED, BLOCK, DOMESTIC_LOCATIONS, SCORE_THRESHOLD


def numeric_match(actual: Column, op: Column, threshold: Column) -> Column:
    """``actual <op> threshold``; an unknown operator never matches, a missing threshold is 0."""
    t = F.coalesce(threshold, F.lit(0))
    compare = (
        F.when(op == "GT", actual > t)
        .when(op == "GTE", actual >= t)
        .when(op == "LT", actual < t)
        .when(op == "LTE", actual <= t)
        .when(op == "EQ", actual == t)
        .when(op == "NEQ", actual != t)
    )
    return F.coalesce(compare, F.lit(False))


def string_match(actual: Column, op: Column, value: Column) -> Column:
    """Equality operators only; null on either side never matches."""
    return F.coalesce(F.when(op == "EQ", actual == value).when(op == "NEQ", actual != value), F.lit(False))


def rule_matches(field: Column, op: Column, threshold: Column, value: Column) -> Column:
    """Does this row match the rule? Only ``amount`` and ``account_id`` are rule fields."""
    return (
        F.when(field == "amount", numeric_match(F.col("amount"), op, threshold))
        .when(field == "account_id", string_match(F.col("account_id"), op, value))
        .otherwise(F.lit(False))
    )


def action_status(action: Column) -> Column:
    """Exactly ``BLOCK`` blocks; every other action, null included, alerts."""
    return F.when(action == BLOCK, BLOCK).otherwise(ALERT)


def score_decision(score: Column, threshold: float = SCORE_THRESHOLD) -> Column:
    return F.when(score >= F.lit(threshold), ALERT).otherwise(APPROVED)


def is_domestic(location: Column) -> Column:
    return F.coalesce(location.isin(*DOMESTIC_LOCATIONS), F.lit(False))


def is_home(home: Column, location: Column) -> Column:
    """Before any home is known, a domestic location counts as home."""
    return F.coalesce(home == location, is_domestic(location))


def log_amount_ratio(amount: Column, average: Column) -> Column:
    return F.when(average > 0, F.log1p(amount / average)).otherwise(F.log1p(F.lit(1.0)))


def location_type(is_home_col: str = "is_home", is_domestic_col: str = "is_domestic") -> Column:
    return (
        F.when(~F.col(is_domestic_col), "Foreign")
        .when(~F.col(is_home_col), "Other domestic")
        .otherwise("Home")
    )


def with_location_type(df: DataFrame) -> DataFrame:
    return df.withColumn("location_type", location_type())


def with_trigger(df: DataFrame) -> DataFrame:
    """What decided the row: the pattern, else the rule, else the model."""
    return df.withColumn("trigger", F.coalesce("cep_pattern", "rule_hit", F.lit("ML")))


def label_name(is_fraud: str = "is_fraud") -> Column:
    return F.when(F.col(is_fraud), "Fraud").otherwise("Normal")


def exclude_accounts(df: DataFrame, like: str | None = None, eq: Sequence[str] = ()) -> DataFrame:
    """Drop test accounts. ``like`` is a SQL pattern, so ``_`` is a wildcard."""
    if like:
        df = df.filter(~F.col("account_id").like(like))
    for account in eq:
        df = df.filter(F.col("account_id") != account)
    return df

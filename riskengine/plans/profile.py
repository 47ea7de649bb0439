"""Profiles of a labelled data set, and its split by account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.functions.predicates import label_name, with_location_type
from riskengine.operators.joins import lookup_join, salted_join
from riskengine.operators.prefix import exact_quantiles, hashed_rank, quantiles_of_counts
from riskengine.session import stored

QUARTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75}


def _exact_sum(col: str):
    return F.sum(F.col(col).cast("decimal(20,0)"))


def combine(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of several data sets, in order of time."""
    for other in others:
        first = first.unionByName(other)
    return first.orderBy("event_time", "transaction_id")


def profile(df: DataFrame, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Rows, fraud share, accounts, time range, and count/mean/std/min/quartiles/max of the amount.

    One reading of the rows: they are counted by amount and by account at once, and all figures come from the counts."""
    counted = stored(
        df.groupingSets([[F.col("amount")], [F.col("account_id")]], "amount", "account_id").agg(
            (F.grouping("amount") == 1).alias("_by_account"),
            F.count(F.lit(1)).alias("n"),
            F.count_if("is_fraud").alias("fraud"),
            F.min("event_time").alias("first"),
            F.max("event_time").alias("last"),
        ),
        "profile",
    )
    amounts = counted.filter("NOT _by_account")
    n, known = F.sum("n"), F.sum(F.when(F.col("amount").isNotNull(), F.col("n")))
    total = F.sum(F.col("amount").cast("decimal(20,0)") * F.col("n").cast("decimal(18,0)"))
    main = amounts.agg(
        F.coalesce(n, F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("fraud"), F.lit(0)).alias("fraud_rows"),
        (F.sum("fraud") * 100.0 / F.nullif(n, F.lit(0))).alias("fraud_percent"),
        F.min("first").alias("first_event"),
        F.max("last").alias("last_event"),
        F.coalesce(known, F.lit(0)).alias("amount_count"),
        (total.cast("double") / known).alias("amount_mean"),
        F.min("amount").alias("amount_min"),
        F.max("amount").alias("amount_max"),
    )
    away = F.col("amount") - main.select("amount_mean").scalar()
    spread = amounts.agg(F.sqrt(F.sum(F.col("n") * away * away) / F.nullif(known - 1, F.lit(0))))
    accounts = counted.filter("_by_account").agg(F.count("account_id"))
    valued = amounts.filter("amount IS NOT NULL").select(F.col("amount").alias("_v"), "n")
    quartiles = quantiles_of_counts(valued, QUARTILES, rows_per_bucket=rows_per_bucket)
    out = main.select(
        "*", spread.scalar().alias("amount_std"), accounts.scalar().alias("accounts"),
        quartiles.select(F.struct(*QUARTILES)).scalar().alias("_quartiles"),
    )
    return out.select("*", "_quartiles.*").drop("_quartiles")


def hour_histogram(df: DataFrame) -> DataFrame:
    """Rows per hour of day and label; hours without rows are left out."""
    hour = F.hour("event_time").cast("long").alias("hour")
    return df.groupBy(label_name().alias("label"), hour).agg(F.count(F.lit(1)).alias("n")).orderBy("label", "hour")


def amount_box(df: DataFrame, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Five-number summary of the amount per label."""
    five = {"low": 0.0, **QUARTILES, "high": 1.0}
    return exact_quantiles(df.withColumn("label", label_name()), "amount", five, ["label"], rows_per_bucket)


def fraud_by_location(df: DataFrame) -> DataFrame:
    return (
        with_location_type(df.filter("is_fraud")).groupBy("location_type").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "location_type")
    )


def account_mean(df: DataFrame) -> DataFrame:
    return df.groupBy("account_id").agg((_exact_sum("amount").cast("double") / F.count("amount")).alias("mean_amount"))


def class_weight(df: DataFrame) -> DataFrame:
    """Whole part of negatives per positive."""
    ratio = F.try_divide(F.count_if(~F.col("is_fraud")), F.count_if("is_fraud"))
    return df.agg(ratio.cast("long").alias("class_weight"))


def account_mismatch(tx: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per account of the transactions: whether the accounts table knows it, and how many of its rows are by another card,
    away from its home or above its usual amount. Accounts that are not in the table, rows without one and unknown
    cards or homes count as no mismatch. The table may name an account twice; its least row counts."""
    facts = F.min(F.struct("card_id", "home_location", "avg_amount")).alias("_facts")
    known = accounts.filter("account_id IS NOT NULL").groupBy("account_id").agg(facts)
    met = lookup_join(tx.select("account_id", "transaction_id", "card_id", "location_name", "amount"), known, "account_id", "left", "transaction_id")
    return met.groupBy("account_id").agg(
        F.max(F.col("_facts").isNotNull()).alias("known"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("card_id") != F.col("_facts.card_id")).alias("other_card"),
        F.count_if(F.col("location_name") != F.col("_facts.home_location")).alias("away"),
        F.count_if(F.col("amount") > F.col("_facts.avg_amount")).alias("above_usual"),
    )


def account_split(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """``train`` or ``test`` for each account, the share taken within accounts with and without fraud.

    Every account has one label (any fraud makes it fraudulent), so the two sets share none.
    """
    accounts = df.groupBy("account_id").agg(F.max("is_fraud").alias("has_fraud"))
    ranked = hashed_rank(accounts, ["has_fraud"], "account_id", f"{seed}:")
    in_train = F.col("rank") <= F.floor(F.col("group_size") * F.lit(train_share))
    return ranked.select("account_id", "has_fraud", F.when(in_train, "train").otherwise("test").alias("part"))


def with_part(df: DataFrame, split: DataFrame, spread_by: str = "transaction_id") -> DataFrame:
    """Rows with the part of their account; an account with much of the data is spread out."""
    return salted_join(df, split.select("account_id", "part"), "account_id", "inner", spread_by)

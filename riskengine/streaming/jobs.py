"""Streaming jobs: micro-batches that run the batch operators over new rows and the history they look back at.

Each batch writes into a folder of its own and reads only those of earlier batches, so a batch that is run again
after a failure gives the same rows once. Late rows are decided like any other: nothing here drops by watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from riskengine import schemas
from riskengine.constants import PRIORITY_ACCOUNTS, RULES_TOPIC, SCORE_THRESHOLD, TRANSACTIONS_TOPIC
from riskengine.operators.cep import CepConfig, cep_decide
from riskengine.operators.feedback import Scorer, serve_in_order
from riskengine.operators.features import DAY_S
from riskengine.operators.joins import members, salted_join
from riskengine.operators.rules import active_rules, apply_rules
from riskengine.operators.slicing import ROWS_PER_SLICE
from riskengine.plans.decide import conclude, reaches_patterns, stage_of
from riskengine.sources.parsing import dlq_records, parse_rules, parse_transactions, split_dlq
from riskengine.sources.sinks import write_batch, write_dlq, write_parts
from riskengine.streaming.compact import BatchTable, bucket_of

LOG_COLUMNS = [c for c in schemas.DECIDED_LOG.fieldNames() if c not in ("event_date", "batch_id")]


def _first_seen(batch: DataFrame, history: DataFrame) -> DataFrame:
    """The batch without what is replayed: one row per transaction, and none that an earlier batch has decided.

    A replayed row has the account and time it had before, so it is part of the history that its batch reads. Rows
    without an id all stay.
    """
    known = batch.filter(F.col("transaction_id").isNotNull()).dropDuplicates(["transaction_id"])
    # The history grows with the look-back; Spark, sizing it by its files, would broadcast its ids through the driver.
    seen = history.select("transaction_id").hint("merge")
    known = known.join(seen, "transaction_id", "left_anti").select(*batch.columns)
    return known.unionByName(batch.filter(F.col("transaction_id").isNull()))


@dataclass
class DecisionLog:
    """The decided rows, by batch and day, and each account's first location.

    Homes never expire, so they are kept apart from the log, of which only the look-back is read.
    """

    path: str

    @property
    def rows(self) -> BatchTable:
        return BatchTable(self.path, "log", schemas.DECIDED_LOG, "account_id", "transaction_id", by_day=True)

    @property
    def homes(self) -> BatchTable:
        return BatchTable(self.path, "homes", schemas.HOMES, "account_id", "account_id")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Merges the folders of all batches up to ``upto``; an account's first home alone is kept."""
        self.rows.compact(spark, upto)
        self.homes.compact(spark, upto, lambda homes: homes.groupBy("account_id").agg(
            F.min_by("home", "batch_id").alias("home"), F.min("batch_id").alias("batch_id")
        ).select(*schemas.HOMES.fieldNames()))

    def history(self, batch: DataFrame, batch_id: int, lookback_s: int) -> DataFrame:
        """Rows of earlier batches that the batch can look back at: its accounts, from its first row's window on."""
        spark = batch.sparkSession
        since = F.min("event_time") - F.expr(f"INTERVAL {lookback_s} SECONDS")
        span = batch.agg(F.unix_micros(since).alias("since")).first()
        # The days that some row looks back over, so that no other folder is even listed. One old row adds its own days
        # alone.
        back = F.sequence(F.to_date(F.col("event_time") - F.expr(f"INTERVAL {lookback_s} SECONDS")), F.to_date("event_time"))
        # With them the buckets of its accounts: the merged files of others are not read.
        found = batch.select(F.explode(back).alias("day"), bucket_of(F.col("account_id")).alias("bucket")).distinct().collect()
        if span.since is None:
            return spark.createDataFrame([], schemas.DECIDED_LOG).select(*LOG_COLUMNS)
        log = self.rows.read(spark, batch_id - 1, sorted({str(r.day) for r in found}), sorted({r.bucket for r in found}))
        recent = log.filter(F.col("event_time") >= F.timestamp_micros(F.lit(span.since)))
        return members(recent.select(*LOG_COLUMNS), batch, "account_id", "transaction_id")

    def with_homes(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Adds ``_stored_home``, null for accounts that no earlier batch has seen."""
        homes = self.homes.read(df.sparkSession, batch_id - 1)
        earlier = homes.groupBy("account_id").agg(
            F.min_by("home", "batch_id").alias("_stored_home")
        )
        return salted_join(df, earlier, "account_id", "left", "transaction_id")

    def append(self, decided: DataFrame, batch_id: int) -> None:
        rows = decided.select(*LOG_COLUMNS, F.to_date("event_time").alias("event_date"), "_stored_home").persist()
        try:
            # By day first: a batch looks back over a few days, however many batches there have been.
            write_parts(rows.drop("_stored_home").withColumn("batch_id", F.lit(batch_id)), f"{self.path}/log", "event_date", "batch_id")
            new = rows.filter(F.col("_stored_home").isNull()).groupBy("account_id").agg(
                F.min_by("location_name", F.struct(F.unix_millis("event_time"), "transaction_id")).alias("home")
            )
            write_batch(new, f"{self.path}/homes", batch_id)
        finally:
            rows.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        """Decisions of all batches, in the decision table's columns."""
        log = self.rows.read(spark).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
        return log.withColumn("ml_score", F.col("ml_score").cast("float")).select(*schemas.DECISION.fieldNames())


@dataclass
class Decider:
    """What it takes to decide a batch. ``updates`` is called at the start of every batch, so a rule update is in
    force from the next one on. ``score`` gives scores from the nine features; what a batch's own decisions do to its
    later averages is worked out in order of time, so where a batch ends changes no answer. Without it the rows bring their score.
    Every ``compact_every`` batches (0: never) the folders of all earlier batches are merged."""

    log: DecisionLog
    updates: Callable[[], DataFrame]
    config: CepConfig = CepConfig()
    priority_accounts: Sequence[str] = PRIORITY_ACCOUNTS
    threshold: float = SCORE_THRESHOLD
    score: Scorer | None = None
    rows_per_slice: int | None = ROWS_PER_SLICE
    compact_every: int = 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            # This batch may be run again; those before it are settled.
            self.log.compact(batch.sparkSession, batch_id - 1)
        batch.persist()
        try:
            self.log.append(self.decide(batch, batch_id), batch_id)
        finally:
            batch.unpersist()

    def decide(self, batch: DataFrame, batch_id: int) -> DataFrame:
        if "ml_score" not in batch.columns:
            batch = batch.withColumn("ml_score", F.lit(None).cast("double"))
        if "decided_at" not in batch.columns:
            batch = batch.withColumn("decided_at", F.current_timestamp())
        # Settled rows keep their pattern, so looking back over the longest window is enough.
        lookback = max(p.window_s for p in self.config.patterns)
        history = self.log.history(batch, batch_id, DAY_S if self.score else lookback)
        batch = _first_seen(batch, history)
        new = apply_rules(batch, active_rules(self.updates())).withColumn("_settled", F.lit(False))
        rows = new.withColumns({c: F.lit(None).cast("string") for c in ("cep_pattern", "stage", "decision")})
        rows = rows.select(*LOG_COLUMNS, "_settled").unionByName(history.withColumn("_settled", F.lit(True)))
        rows = cep_decide(rows, self.config, reaches_patterns(self.priority_accounts), "_settled")
        rows = rows.withColumn("stage", stage_of(self.priority_accounts))
        if self.score is not None:
            def at_home(featured: DataFrame) -> DataFrame:
                featured = self.log.with_homes(featured, batch_id)
                known = (F.col("_stored_home") == F.col("location_name")).cast("double")
                return featured.withColumn("is_home", F.coalesce(known, F.col("is_home")))

            settled = F.when(F.col("_settled"), F.col("decision") == "APPROVED")
            # The feature is a double of the same name; the log keeps the whole amount.
            rows = rows.withColumn("_whole", F.col("amount"))
            served = serve_in_order(
                rows, self.score, self.threshold, rows_per_slice=self.rows_per_slice, known=settled, amend=at_home
            )
            scored = served.withColumn("amount", F.col("_whole")).filter(~F.col("_settled"))
        else:
            scored = self.log.with_homes(rows.filter(~F.col("_settled")), batch_id)
        return conclude(scored, self.config, self.threshold)


def decide_stream(transactions: DataFrame, decider: Decider, checkpoint: str, **trigger) -> StreamingQuery:
    """Decides a stream of typed transactions into the decider's log."""
    return (
        transactions.writeStream.foreachBatch(decider)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def decide_messages(
    raw: DataFrame, decider: Decider, dlq_path: str, checkpoint: str, source: str = TRANSACTIONS_TOPIC, **trigger
) -> StreamingQuery:
    """The same from raw messages: bad ones go to the dead-letter table of the batch, the rest are decided."""

    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_transactions(batch)
        parsed.persist()
        try:
            good, bad = split_dlq(parsed)
            write_dlq(dlq_records(bad), dlq_path, source, batch_id)
            decider(good.select(*schemas.TRANSACTION.fieldNames()), batch_id)
        finally:
            parsed.unpersist()

    return (
        raw.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"})).start()
    )


def rule_stream(raw: DataFrame, path: str, dlq_path: str, checkpoint: str, source: str = RULES_TOPIC, **trigger) -> StreamingQuery:
    """Appends valid rule updates to the table that deciders read."""

    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_rules(batch)
        parsed.persist()
        try:
            good, bad = split_dlq(parsed)
            write_dlq(dlq_records(bad), dlq_path, source, batch_id)
            rules = good.withColumn("updated_at", F.current_timestamp()).withColumn("seq", F.col("offset"))
            write_batch(rules.select(*schemas.RULE_UPDATE.fieldNames()), path, batch_id)
        finally:
            parsed.unpersist()

    return (
        raw.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"})).start()
    )


def read_rule_table(spark: SparkSession, path: str) -> DataFrame:
    """All rule updates so far; no rows before the first batch."""
    return _rule_table(path).read(spark).drop("batch_id")


def compact_rule_table(spark: SparkSession, path: str, upto: int) -> None:
    """Merges the rule updates of all batches up to ``upto``, which must not be the stream's last."""
    _rule_table(path).compact(spark, upto)


def _rule_table(path: str) -> BatchTable:
    schema = StructType([*schemas.RULE_UPDATE.fields, StructField("batch_id", LongType())])
    return BatchTable(path, "", schema, "rule_id", "seq")


#: Size of the latency sketches: ranks are exact up to about so many rows, and beyond within 0.2 % of the rows.
SKETCH_K = 2048
METRIC_QUANTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def metrics_stream(decisions: DataFrame, late: str = "5 seconds") -> DataFrame:
    """Per-second throughput and latency of a decision stream, for append mode: a second comes out once, when ``late`` has
    passed, and is forgotten. Latencies are kept as a sketch, so seconds add up to longer spans (:func:`metric_spans`)."""
    latency = F.unix_millis("decided_at") - F.unix_millis("produced_at")
    return (
        decisions.withWatermark("decided_at", late)
        .groupBy(F.window("decided_at", "1 second"))
        .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint(latency, SKETCH_K).alias("sketch"), F.max(latency).alias("max_ms"))
        .select(F.col("window.start").alias("second"), "n", "sketch", "max_ms")
    )


def with_quantiles(metrics: DataFrame) -> DataFrame:
    """The sketch as percentiles."""
    found = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias(name) for name, p in METRIC_QUANTILES.items()]
    return metrics.select(*[c for c in metrics.columns if c != "sketch"], *found)


def metric_spans(metrics: DataFrame, unit: str) -> DataFrame:
    """Seconds added up to spans of a ``unit`` as in ``date_trunc``; sketches are merged, latencies not read again."""
    return metrics.groupBy(F.date_trunc(unit, "second").alias(unit)).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"), F.max("max_ms").alias("max_ms")
    )


def write_metrics(metrics: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends finished seconds; a batch that is run again replaces its own."""
    return (
        metrics.writeStream.outputMode("append").foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()
    )


def without_replays(transactions: DataFrame, within: str = "10 minutes") -> DataFrame:
    """Drops repeats of a transaction that come within a time of each other."""
    return transactions.withWatermark("event_time", within).dropDuplicatesWithinWatermark(["transaction_id"])

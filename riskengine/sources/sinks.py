"""Writes. Each is safe to repeat: a batch that is run again under its number replaces what its first try left, and no
other. The caller gives the number, so two runs never share one by default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine import schemas
from riskengine.constants import APPROVED
from riskengine.operators.dedup import latest_by_key
from riskengine.sources.parsing import as_messages


def write_batch(df: DataFrame, path: str, batch_id: int, by: str | None = None) -> None:
    """One folder per batch, replaced as a whole; inside, optionally, one folder per value of ``by``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if by:
        writer = writer.partitionBy(by)
    writer.parquet(f"{path}/batch_id={batch_id}")


def write_parts(df: DataFrame, path: str, *by: str) -> None:
    """Replaces the folders of ``by`` that the rows fall in, and leaves all others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_decisions(decisions: DataFrame, path: str, batch_id: int) -> None:
    """The decision table, by day decided."""
    rows = decisions.select(*schemas.DECISION.fieldNames(), F.to_date("decided_at").alias("decided_date"))
    write_batch(rows, path, batch_id, "decided_date")


def write_alerts(decisions: DataFrame, path: str, batch_id: int) -> None:
    """The decisions that are not APPROVED, in a table of their own."""
    write_decisions(decisions.filter(F.col("decision") != APPROVED), path, batch_id)


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of each transaction."""
    return latest_by_key(spark.read.parquet(path), ["transaction_id"], ["decided_at", "batch_id"])


def write_dlq(records: DataFrame, path: str, source: str, batch_id: int) -> None:
    """Dead letters of one batch of one source; sources may share a path."""
    as_messages(records).write.mode("overwrite").text(f"{path}/source={source}/batch_id={batch_id}")


def write_dlq_stream(records: DataFrame, fmt: str, checkpoint: str, trigger: dict | None = None, **options: str):
    """A running query that sends DLQ records on, to ``kafka`` (servers and topic in ``options``) or to files."""
    writer = as_messages(records).writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def write_ground_truth(df: DataFrame, path: str) -> None:
    """Appends labelled transactions; amounts are whole."""
    df.withColumn("amount", F.col("amount").cast("long")).select(*schemas.GROUND_TRUTH.fieldNames()).write.mode("append").parquet(path)


def drop_labels(df: DataFrame) -> DataFrame:
    """What may be published."""
    return df.drop("is_fraud", "fraud_pattern")


def write_report(df: DataFrame, path: str, *order: str) -> None:
    """CSV parts with a header, sorted across and within the parts."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def reset_table(spark: SparkSession, path: str, schema) -> None:
    """Empties a table and keeps its schema."""
    overwrite_table(spark.createDataFrame([], schema), path)

"""Batch and streaming reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine import schemas
from riskengine.constants import RULES_TOPIC, TRANSACTIONS_TOPIC
from riskengine.session import prepare


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}


def read_messages(
    spark: SparkSession, fmt: str, topic: str, path: str | None = None, streaming: bool = True, **options: str
) -> DataFrame:
    """Raw messages as (value, topic, partition, offset).

    ``kafka`` needs its connector on the classpath. ``text`` files hold one message per line and know no offset;
    ``parquet`` and ``json`` files hold messages with their envelope.
    """
    prepare(spark)
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    if fmt == "kafka":
        raw = reader.load()
    elif fmt == "text":
        raw = reader.load(path)
    else:
        raw = reader.schema(schemas.MESSAGE).load(path)
    if fmt == "text":
        raw = raw.select(
            "value", F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.lit(None).cast("long").alias("offset")
        )
    return raw.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def read_transactions(spark: SparkSession, fmt: str, path: str | None = None, streaming: bool = True, **options: str) -> DataFrame:
    return read_messages(spark, fmt, TRANSACTIONS_TOPIC, path, streaming, **options)


def read_rule_updates(spark: SparkSession, fmt: str, path: str | None = None, streaming: bool = True, **options: str) -> DataFrame:
    """Rule messages; their topic has one partition, so the offset is the order of updates."""
    return read_messages(spark, fmt, RULES_TOPIC, path, streaming, **options).withColumn("seq", F.col("offset"))


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    prepare(spark)
    if path.endswith((".csv", ".csv.gz")):
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.schema(schema).parquet(path)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return _table(spark, path, schemas.ACCOUNT)


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """The labelled training set; event_time is ISO 8601 text in a CSV."""
    return _table(spark, path, schemas.LABELLED)


def read_load_levels(spark: SparkSession, path: str) -> DataFrame:
    prepare(spark)
    return spark.read.schema(schemas.LOAD_LEVEL).option("multiLine", True).json(path)

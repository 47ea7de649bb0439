"""Table and stream schemas."""

from pyspark.sql import types as T

TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("produced_at", T.TimestampType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("card_id", T.StringType()),
    T.StructField("amount", T.LongType()),
    T.StructField("channel", T.StringType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("status", T.StringType()),
])

RULE = T.StructType([
    T.StructField("rule_id", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("operator", T.StringType()),
    T.StructField("threshold", T.LongType()),
    T.StructField("value", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
])

# A rule plus its place in the update log.
RULE_UPDATE = T.StructType(
    RULE.fields + [T.StructField("seq", T.LongType()), T.StructField("updated_at", T.TimestampType())]
)

DECISION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("amount", T.DecimalType(18, 2)),
    T.StructField("rule_hit", T.StringType()),
    T.StructField("cep_pattern", T.StringType()),
    T.StructField("ml_score", T.FloatType()),
    T.StructField("produced_at", T.TimestampType()),
    T.StructField("decided_at", T.TimestampType()),
    T.StructField("decision", T.StringType()),
])

ACCOUNT = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("card_id", T.StringType()),
    T.StructField("home_location", T.StringType()),
    T.StructField("avg_amount", T.LongType()),
])

GROUND_TRUTH = T.StructType(
    TRANSACTION.fields
    + [T.StructField("is_fraud", T.BooleanType()), T.StructField("fraud_pattern", T.StringType())]
)

LABELLED = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("amount", T.LongType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("is_home", T.BooleanType()),
    T.StructField("is_domestic", T.BooleanType()),
    T.StructField("is_fraud", T.BooleanType()),
])

LOAD_LEVEL = T.StructType([
    T.StructField("tps", T.LongType()),
    T.StructField("start", T.TimestampType()),
    T.StructField("end", T.TimestampType()),
])

# Raw message as a broker delivers it.
MESSAGE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# What a decision stream keeps of every row, to look back at; and the first location of every account.
DECIDED_LOG = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("amount", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("produced_at", T.TimestampType()),
    T.StructField("rule_hit", T.StringType()),
    T.StructField("rule_status", T.StringType()),
    T.StructField("cep_pattern", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("ml_score", T.DoubleType()),
    T.StructField("decision", T.StringType()),
    T.StructField("decided_at", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("batch_id", T.LongType()),
])
HOMES = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("home", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

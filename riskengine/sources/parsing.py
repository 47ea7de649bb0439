"""From raw JSON messages to checked, typed rows.

A message is read once into a struct. Properties with a pattern or a list of values are read as text, since no number
or flag can pass for one; the others keep their JSON type. ``errors`` lists all that is wrong, in the order of the
fields, and a row with any error has null columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine import constants as C

_UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
_DATE_TIME = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"
_NUMBER = "decimal(38,9)"


@dataclass(frozen=True)
class Field:
    """One property of a message. ``kind`` is string, uuid, date-time, number, integer or boolean."""

    name: str
    kind: str
    required: bool = True
    pattern: str | None = None
    values: Sequence[str] = ()

    @property
    def json_type(self) -> str:
        return "string" if self.kind in ("uuid", "date-time") else self.kind

    @property
    def keeps_type(self) -> bool:
        return self.kind in ("string", "number", "integer", "boolean") and not (self.pattern or self.values)

    def read(self) -> list[Column]:
        """The property's text and, where it matters, its type."""
        raw = F.col(f"_doc.{self.name}")
        if not self.keeps_type:
            return [raw.alias(self.name)]
        return [
            F.try_variant_get(raw, "$", "string").alias(self.name),
            F.schema_of_variant(raw).alias(f"{self.name}_type"),
        ]

    @property
    def text(self) -> Column:
        return F.col(f"_text.{self.name}")

    @property
    def number(self) -> Column:
        """The exact number, null if it is too large for any amount."""
        return self.text.try_cast(_NUMBER)

    @property
    def whole(self) -> Column:
        """The number without its fraction, null if that is no 64-bit integer."""
        cut = F.when(self.number < 0, F.ceil(self.number)).otherwise(F.floor(self.number))
        return cut.try_cast("long")

    def error(self) -> Column:
        """What is wrong with the property, or null."""
        text, wrong_type = self.text, f"{self.name}: must be of type {self.json_type}"
        absent = F.when(F.array_contains("_keys", self.name), wrong_type)
        if self.required:
            absent = absent.otherwise(f"{self.name}: required but missing")
        found = F.when(text.isNull(), absent)
        if self.keeps_type:
            json_type = {"string": "^STRING$", "boolean": "^BOOLEAN$"}.get(self.kind, "^(BIGINT|DECIMAL|DOUBLE)")
            found = found.when(~F.col(f"_text.{self.name}_type").rlike(json_type), wrong_type)
        if self.kind == "integer":
            found = found.when(self.number != F.floor(self.number), wrong_type)
        if self.kind in ("number", "integer"):
            found = found.when(self.whole.isNull(), f"{self.name}: out of range")
        if self.pattern:
            found = found.when(~text.rlike(self.pattern), f"{self.name}: must match {self.pattern}")
        if self.values:
            found = found.when(~text.isin(*self.values), f"{self.name}: must be one of {', '.join(self.values)}")
        if self.kind == "uuid":
            found = found.when(~text.rlike(_UUID), f"{self.name}: must be a uuid")
        if self.kind == "date-time":
            time = F.when(text.rlike(_DATE_TIME), F.try_to_timestamp(F.upper(text)))
            found = found.when(time.isNull(), f"{self.name}: must be a date-time")
        return found

    def value(self) -> Column:
        if self.kind in ("number", "integer"):
            # Fractions are cut off, toward zero; a missing number is 0.
            return self.whole if self.required else F.coalesce(self.whole, F.lit(0))
        if self.kind == "boolean":
            return self.text.cast("boolean")
        if self.kind == "date-time":
            return F.try_to_timestamp(F.upper(self.text))
        return self.text


TRANSACTION_FIELDS = (
    Field("transaction_id", "uuid"),
    Field("produced_at", "date-time"),
    Field("event_time", "date-time"),
    Field("account_id", "string", pattern=C.ACCOUNT_ID_PATTERN),
    Field("card_id", "string", pattern=C.CARD_ID_PATTERN),
    Field("amount", "number"),
    Field("channel", "string", values=C.CHANNELS),
    Field("location_name", "string"),
    Field("status", "string", values=C.STATUSES),
)
RULE_FIELDS = (
    Field("rule_id", "string"),
    Field("field", "string", values=C.RULE_FIELDS),
    Field("operator", "string", values=C.RULE_OPERATORS),
    Field("threshold", "integer", required=False),
    Field("value", "string", required=False),
    Field("action", "string", values=C.RULE_ACTIONS),
    Field("enabled", "boolean"),
)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row however often they are used.

    Catalyst would copy their expressions into every use, a filter above included; a generator of one row holds them
    in place.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def _parse(raw: DataFrame, fields: Sequence[Field]) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {'VARIANT' if f.keeps_type else 'STRING'}" for f in fields)
    df = _once(raw, _doc=F.from_json("value", schema), _keys=F.json_object_keys("value"))
    df = _once(df, _text=F.struct(*[c for f in fields for c in f.read()]))
    known = F.array(*[F.lit(f.name) for f in fields])
    extra = F.transform(F.array_except("_keys", known), lambda k: F.concat(k, F.lit(": not allowed")))
    found = F.concat(F.array_compact(F.array(*[f.error() for f in fields])), extra)
    # Only what has no keys is looked at again, to tell broken text from another kind of value.
    no_object = F.when(F.try_parse_json("value").isNull(), "not valid JSON").otherwise("must be an object")
    df = _once(df, errors=F.when(F.col("_keys").isNull(), F.array(no_object)).otherwise(found))
    good = F.size("errors") == 0
    columns = [F.when(good, f.value()).alias(f"_v_{f.name}") for f in fields]
    out = df.select(*raw.columns, "errors", *columns)
    # Rule messages have a property called value too, so the raw text moves aside first.
    out = out.withColumnRenamed("value", "raw")
    return out.withColumnsRenamed({f"_v_{f.name}": f.name for f in fields})


def parse_transactions(raw: DataFrame) -> DataFrame:
    """Typed transaction columns and ``errors``, beside the envelope and the raw text."""
    return _parse(raw, TRANSACTION_FIELDS)


def parse_rules(raw: DataFrame) -> DataFrame:
    return _parse(raw, RULE_FIELDS)


def with_error_message(df: DataFrame) -> DataFrame:
    return df.withColumn("error_message", F.concat_ws("; ", "errors"))


def split_dlq(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the envelope of errors, and the bad ones."""
    return parsed.filter(F.size("errors") == 0).drop("errors", "raw"), parsed.filter(F.size("errors") > 0)


def dlq_records(bad: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """One JSON envelope per bad message, with the column names it has on the wire."""
    stamp = F.current_timestamp() if failed_at is None else failed_at
    return with_error_message(bad).select(
        F.col("topic").alias("sourceTopic"),
        "partition",
        "offset",
        F.col("raw").alias("rawPayload"),
        F.col("error_message").alias("errorMessage"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("failedAt"),
    )


def as_messages(records: DataFrame) -> DataFrame:
    """DLQ records as JSON text, for a message sink."""
    return records.select(F.to_json(F.struct(*records.columns)).alias("value"))

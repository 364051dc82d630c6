"""Discrepancies as keyed JSON events."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the published events.
TOPIC = "discrepancy.events"
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3"}

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("discrepancy_id", T.StringType()),
        T.StructField("awb_number", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("courier_id", T.IntegerType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("geo_id", T.IntegerType()),
        T.StructField("discrepancy_type", T.StringType()),
        T.StructField("expected_value", T.DoubleType()),
        T.StructField("actual_value", T.DoubleType()),
        T.StructField("variance_rs", T.DoubleType()),
        T.StructField("severity", T.StringType()),
        T.StructField("detected_at", T.StringType()),
        T.StructField("idempotency_key", T.StringType()),
    ]
)


def event_rows(discrepancies: DataFrame, detected_at: datetime.datetime, batch_id: str | None = None) -> DataFrame:
    """Event fields: amounts as floating point, the detection time as text, the id repeated as key."""
    rows = discrepancies if batch_id is None else discrepancies.where(F.col("batch_id") == batch_id)
    stamped = rows.withColumn("detected_at", F.lit(detected_at.isoformat(" ", "microseconds"))).withColumn(
        "idempotency_key", F.col("discrepancy_id")
    )
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])


def event_messages(events: DataFrame) -> DataFrame:
    """Key and JSON value, as a topic or a text file takes them."""
    value = F.to_json(F.struct(*EVENT_SCHEMA.fieldNames()), {"ignoreNullFields": "false"})
    return events.select(F.col("discrepancy_id").alias("key"), value.alias("value"))


def parse_messages(messages: DataFrame, *fields: str) -> DataFrame:
    """The events of messages, or some of their fields; the others are then passed over and not converted."""
    schema = T.StructType([EVENT_SCHEMA[name] for name in fields]) if fields else EVENT_SCHEMA
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")


def write_events(events: DataFrame, path: str) -> None:
    """JSON lines below ``path``."""
    event_messages(events).select("value").write.mode("overwrite").text(path)

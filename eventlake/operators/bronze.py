"""Message envelope and JSON payload to the raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.schemas import BAD_RECORD_COLUMNS, BRONZE_COLUMNS, EVENT_COLUMNS, EVENT_SCHEMA, MESSAGE_COLUMNS, conform


def parse_messages(messages: DataFrame) -> DataFrame:
    """Flatten messages to the raw columns, the message columns and ``raw_json``.

    Text that is no JSON object gives NULL in every payload column. Works on static and streaming
    frames alike.
    """
    text = F.col("value").cast("string")
    envelope = [F.col(name.removeprefix("kafka_")).alias(name) for name in MESSAGE_COLUMNS]
    parsed = messages.select(F.from_json(text, EVENT_SCHEMA).alias("event"), *envelope, text.alias("raw_json"))
    return parsed.select(*(f"event.{c}" for c in EVENT_COLUMNS), *MESSAGE_COLUMNS, "raw_json")


def identified() -> Column:
    """Routing rule of the raw layer: a record without an event id is a bad record."""
    return F.col("event_id").isNotNull()


def good_records(parsed: DataFrame) -> DataFrame:
    return conform(parsed.where(identified()), BRONZE_COLUMNS, "raw layer")


def bad_records(parsed: DataFrame) -> DataFrame:
    return conform(parsed.where(~identified()), BAD_RECORD_COLUMNS, "bad records")

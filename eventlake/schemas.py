"""Column contracts of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and their order are the public table contracts.
RAW_COLUMNS = [
    "time",
    "place",
    "status",
    "tsunami",
    "significance",
    "data_type",
    "magnitudo",
    "state",
    "longitude",
    "latitude",
    "depth",
    "date",
]
EVENT_METADATA_COLUMNS = ["event_id", "ingested_at", "source_file"]
MESSAGE_COLUMNS = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"]
QUALITY_COLUMNS = [
    "event_timestamp",
    "year",
    "month",
    "day",
    "hour",
    "record_natural_key",
    "invalid_latitude",
    "invalid_longitude",
    "missing_magnitudo",
    "missing_depth",
    "negative_depth",
    "quality_score",
    "is_valid_record",
]
FEATURE_COLUMNS = [
    "event_id",
    "event_timestamp",
    "year",
    "month",
    "day",
    "hour",
    "latitude",
    "longitude",
    "depth",
    "significance",
    "tsunami",
    "state",
    "status",
    "data_type",
    "magnitudo",
    "abs_latitude",
    "abs_longitude",
    "depth_bucket",
    "magnitude_bucket",
    "is_shallow",
    "is_medium_depth",
    "is_deep",
    "is_high_significance",
    "is_tsunami",
    "state_index",
]
RISK_COLUMNS = [
    "event_id",
    "latitude",
    "longitude",
    "depth",
    "magnitudo",
    "significance",
    "month",
    "hour",
    "state",
    "state_index",
    "tsunami",
]

EVENT_COLUMNS = RAW_COLUMNS + EVENT_METADATA_COLUMNS
BRONZE_COLUMNS = EVENT_COLUMNS + MESSAGE_COLUMNS
BAD_RECORD_COLUMNS = ["raw_json"] + MESSAGE_COLUMNS
SILVER_COLUMNS = BRONZE_COLUMNS + QUALITY_COLUMNS

_TYPES = {
    "kafka_partition": T.IntegerType(),
    "kafka_offset": T.LongType(),
    "kafka_timestamp": T.TimestampType(),
}
#: Types from the clean layer on, where they are not text.
_CLEAN_TYPES = {
    **_TYPES,
    "time": T.LongType(),
    **dict.fromkeys(["date", "ingested_at", "event_timestamp"], T.TimestampType()),
    **dict.fromkeys(["tsunami", "significance", "year", "month", "day", "hour", "quality_score"], T.IntegerType()),
    **dict.fromkeys(["magnitudo", "longitude", "latitude", "depth", "abs_latitude", "abs_longitude", "state_index"], T.DoubleType()),
    **dict.fromkeys([c for c in [*QUALITY_COLUMNS, *FEATURE_COLUMNS] if c.startswith(("invalid_", "missing_", "negative_", "is_"))], T.BooleanType()),
}


def _struct(columns: list[str], types: dict[str, T.DataType] = _TYPES) -> T.StructType:
    return T.StructType([T.StructField(c, types.get(c, T.StringType()), True) for c in columns])


#: JSON payload: everything arrives as text and is typed in the clean layer.
EVENT_SCHEMA = _struct(EVENT_COLUMNS)
BRONZE_SCHEMA = _struct(BRONZE_COLUMNS)
BAD_RECORD_SCHEMA = _struct(BAD_RECORD_COLUMNS)

SILVER_SCHEMA = _struct(SILVER_COLUMNS, _CLEAN_TYPES)
FEATURE_SCHEMA = _struct(FEATURE_COLUMNS, _CLEAN_TYPES)
RISK_SCHEMA = _struct(RISK_COLUMNS, _CLEAN_TYPES)

#: What a message source delivers, whether the broker or a folder of files.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
    ]
)


def conform(df: DataFrame, columns: list[str], layer: str) -> DataFrame:
    """Project to a layer's columns in order; name whatever is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{layer}: missing columns {missing}")
    return df.select(*columns)

"""Geo-event inputs derived from the ``events`` test table, with the usual defects built in.

The SQL text is shared by Spark and DuckDB. Only the two expressions in ``DIALECTS`` differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.events import message_key, message_value
from eventlake.schemas import EVENT_COLUMNS

DIALECTS = {
    "spark": {"ms": "unix_millis(CAST(ts AS TIMESTAMP))", "kts": "CAST(ts AS TIMESTAMP)"},
    "duckdb": {"ms": "epoch_us(ts)//1000", "kts": "ts"},
}

RAW_EVENTS = """
SELECT CASE WHEN event_id % 142 = 0 THEN 'NaN' WHEN event_id % 213 = 0 THEN '1.5e12' WHEN event_id % 355 = 0 THEN '1000d'
    ELSE CAST({ms} AS STRING) END AS time,
  '  Zone ' || CAST(user_id AS STRING) || ' ' AS place,
  ' ' || upper(event_type) || ' ' AS status,
  CASE WHEN event_type='error' THEN '1' ELSE '0' END AS tsunami,
  CAST(CAST(floor(value*10) AS BIGINT) AS STRING) AS significance,
  CASE WHEN event_type='signup' THEN ' Quarry Blast ' ELSE ' Earthquake ' END AS data_type,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN 'n/a'
    ELSE CAST(CAST(floor((CAST(floor(value*100) AS BIGINT) % 900)/100) AS BIGINT) AS STRING)
         || '.' || lpad(CAST(CAST(floor(value*100) AS BIGINT) % 100 AS STRING),2,'0') END AS magnitudo,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE ' State ' || CAST(user_id % 50 AS STRING) || ' ' END AS state,
  CASE WHEN event_id % 53 = 0 THEN '200' ELSE CAST(((event_id*7919) % 36000 - 18000)/100 AS STRING) END AS longitude,
  CASE WHEN event_id % 59 = 0 THEN '100' ELSE CAST(((event_id*10007) % 18000 - 9000)/100 AS STRING) END AS latitude,
  CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 67 = 0 THEN '-5'
    ELSE CAST((event_id*31) % 700 AS STRING) END AS depth,
  CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 73 = 0 THEN 'unknown'
    ELSE CAST(ts AS STRING) || '+00:00' END AS date,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'event-' || CAST(event_id AS STRING) END AS event_id,
  '2024-01-01T00:00:00+00:00' AS ingested_at, 'events.parquet' AS source_file,
  'seismic-events' AS kafka_topic, CAST(user_id % 3 AS INT) AS kafka_partition,
  event_id AS kafka_offset, {kts} AS kafka_timestamp
FROM {events}
"""

#: A broker may deliver again: the same payload at a later offset.
REDELIVERED = """
SELECT * FROM {raw}
UNION ALL
SELECT {columns}, kafka_topic, kafka_partition, kafka_offset + 1000000000 AS kafka_offset, kafka_timestamp
FROM {raw} WHERE kafka_offset % 101 = 0
"""


def raw_sql(dialect: str, events: str = "{events}") -> str:
    return RAW_EVENTS.format(events=events, **DIALECTS[dialect])


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(raw_sql("spark"), events=events_table(spark, sf_dir))


#: Two deliveries of the raw events. The second also repeats records of both at later offsets,
#: some unchanged and some with another place, so with a known event id but a new natural key.
DELIVERIES = """
SELECT {columns}, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp,
  CASE WHEN kafka_timestamp < TIMESTAMP '2024-01-16 00:00:00' THEN 1 ELSE 2 END AS delivery
FROM {raw}
UNION ALL
SELECT {columns}, kafka_topic, kafka_partition, kafka_offset + 1000000000 AS kafka_offset, kafka_timestamp, 2 AS delivery
FROM {raw} WHERE kafka_offset % 101 = 0
UNION ALL
SELECT {moved}, kafka_topic, kafka_partition, kafka_offset + 2000000000 AS kafka_offset, kafka_timestamp, 2 AS delivery
FROM {raw} WHERE kafka_offset % 103 = 0
"""

REGRESSION_PREDICTIONS = """
SELECT event_id, magnitudo,
  magnitudo + ((CAST(substr(event_id, 7) AS BIGINT) * 37) % 200 - 100) / 100 AS prediction
FROM {features}
"""

SCORES = """
SELECT event_id, CAST(tsunami AS DOUBLE) AS label,
  ((CAST(substr(event_id, 7) AS BIGINT) * 7919) % 997) / 997 AS score
FROM {features}
"""

CLASSIFICATION_PREDICTIONS = """
SELECT event_id, label, score, CASE WHEN score >= 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction
FROM {scores}
"""

RUNS = """
SELECT 'run-' || CAST(event_id AS STRING) AS run_id,
  CASE WHEN event_type IN ('click', 'view') THEN 'magnitude_regression' ELSE 'tsunami_classification' END AS experiment,
  'FINISHED' AS status, {kts} AS start_time, {kts} + INTERVAL '1' MINUTE AS end_time,
  'models/run-' || CAST(event_id AS STRING) AS artifact_uri,
  event_type AS model_name, CAST(user_id % 10 AS STRING) AS max_depth,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS rmse, value / 2 AS mae, 1 - value / 1000 AS r2,
  CASE WHEN event_type IN ('click', 'view') THEN 'regression' ELSE 'classification' END AS model_family
FROM {events}
"""

#: Payloads that are no event object, by message offset.
BROKEN_PAYLOADS = {79: "'null'", 83: "'[]'", 89: "'{bad'", 107: "CAST(NULL AS STRING)"}


def deliveries_sql(raw: str) -> str:
    columns = ", ".join(EVENT_COLUMNS)
    moved = ", ".join("place || 'moved' AS place" if c == "place" else c for c in EVENT_COLUMNS)
    return DELIVERIES.format(raw=raw, columns=columns, moved=moved)


def redelivered_sql(raw: str) -> str:
    return REDELIVERED.format(raw=raw, columns=", ".join(EVENT_COLUMNS))


def runs_sql(dialect: str, events: str = "{events}") -> str:
    return RUNS.format(events=events, **DIALECTS[dialect])


def broken_payload(offset: str, otherwise: str) -> str:
    cases = " ".join(f"WHEN {offset} % {n} = 0 THEN {text}" for n, text in BROKEN_PAYLOADS.items())
    return f"CASE {cases} ELSE {otherwise} END"


def deliveries(raw: DataFrame) -> DataFrame:
    return raw.sparkSession.sql(deliveries_sql("{raw}"), raw=raw)


def redelivered(raw: DataFrame) -> DataFrame:
    return raw.sparkSession.sql(redelivered_sql("{raw}"), raw=raw)


def as_messages(raw: DataFrame) -> DataFrame:
    """Raw events as broker messages; some payloads are broken."""
    value = raw.withColumn("payload", message_value())
    return value.select(
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
        message_key().cast("binary").alias("key"),
        F.expr(broken_payload("kafka_offset", "payload")).cast("binary").alias("value"),
    )


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = spark.sql(runs_sql("spark"), events=events_table(spark, sf_dir))
    params = F.create_map(F.lit("model_name"), "model_name", F.lit("maxDepth"), "max_depth")
    metrics = F.create_map(F.lit("rmse"), "rmse", F.lit("mae"), "mae", F.lit("r2"), "r2")
    tags = F.create_map(F.lit("model_family"), "model_family", F.lit("mlflow.user"), F.lit("tester"))
    return flat.select(
        "run_id", "experiment", "status", "start_time", "end_time", "artifact_uri",
        params.alias("params"), metrics.alias("metrics"), tags.alias("tags"),
    )

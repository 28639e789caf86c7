"""Message topics: a Kafka topic, or a folder of Parquet files with the same six columns.

The folder form is what is tested. The Kafka form needs the Kafka package on the class path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA, ENVELOPE_SCHEMA
from eventlake.sources.tables import SELF_DESCRIBED, read_if_exists


#: Bounds a micro-batch of a topic, so that a backlog of any size is worked off in steps.
MAX_OFFSETS = 500_000_000


@dataclass(frozen=True)
class KafkaTopic:
    """A topic and how a stream reads it."""

    servers: str
    topic: str
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = MAX_OFFSETS

    def read_options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": "false",
        }
        if self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return options

    def write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": self.topic}


def kafka_stream(spark: SparkSession, topic: KafkaTopic) -> DataFrame:
    return spark.readStream.format("kafka").options(**topic.read_options()).load()


def publish_kafka(messages: DataFrame, topic: KafkaTopic) -> None:
    messages.write.format("kafka").options(**topic.write_options()).save()


def folder_stream(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def _next_offset(spark: SparkSession, path: str) -> int:
    """The offset after the last one published to a topic folder.

    The last publish left it as a mark beside the folder, with the number of files it saw. Where files came without one, from
    a publish that ended early, the offsets are read.
    """
    topic, marks = read_if_exists(spark, path), read_if_exists(spark, _marks(path))
    if topic is None:
        return 0
    last = marks.orderBy(F.desc("next_offset")).first() if marks is not None else None
    if last is not None and last["files"] == len(topic.inputFiles()):
        return last["next_offset"]
    return (topic.agg(F.max("offset")).first()[0] or 0) + 1


def _marks(path: str) -> str:
    return path.rstrip("/") + "_marks"


def publish_folder(messages: DataFrame, path: str, topic: str, *, partitions: int = 3) -> None:
    """Append keyed messages to a topic folder. One publisher per folder.

    As on a broker the partition follows from the key; a message without a given offset gets one that is unique in the folder:
    it goes on after the last publish and rises within its write task.
    """
    spark, columns = messages.sparkSession, set(messages.columns)
    envelope = {
        "topic": F.lit(topic),
        "partition": F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int"),
        "offset": F.monotonically_increasing_id() + (0 if "offset" in columns else _next_offset(spark, path)),
        "timestamp": F.current_timestamp(),
    }
    filled = messages.withColumns({c: e for c, e in envelope.items() if c not in columns})
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in ENVELOPE_SCHEMA]
    counted = Observation()
    filled.select(*typed).observe(counted, F.max("offset").alias("last")).write.mode("append").parquet(path)
    last = counted.get["last"]
    mark = [((-1 if last is None else last) + 1, len(spark.read.parquet(path).inputFiles()))]
    spark.createDataFrame(mark, "next_offset bigint, files bigint").coalesce(1).write.mode("append").parquet(_marks(path))


def raw_layer_stream(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The raw table as a stream. Its columns are declared, but to a format that knows them."""
    reader = spark.readStream.format(fmt)
    if fmt not in SELF_DESCRIBED:
        reader = reader.schema(BRONZE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(*BRONZE_COLUMNS)

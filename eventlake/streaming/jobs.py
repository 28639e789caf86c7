"""The two streams: messages to the raw layer, raw layer to the clean layer."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.operators.bronze import bad_records, good_records, identified, parse_messages
from eventlake.operators.silver import clean, quarantined_records, valid_records
from eventlake.operators.upsert import first_per_key, unstored_records
from eventlake.schemas import SILVER_COLUMNS, conform
from eventlake.session import require_utc, scratch_path, written
from eventlake.sources.folders import Folders
from eventlake.sources.key_index import BUCKETS, KeyIndex, index_path
from eventlake.sources.tables import BATCH_COLUMN, read_if_exists, write_batch

LOG = logging.getLogger(__name__)

PROCESSING_TIME = "10 seconds"


@contextmanager
def _kept(df: DataFrame, name: str, **counts: Column) -> Iterator[tuple[DataFrame, dict[str, int]]]:
    """Hold a frame that is read more than once, in the shared folder, and what is counted while it is written.

    However large, it takes no memory from the work on it, and the loss of executors does not undo it. It goes with the block.
    """
    spark, path, counted = df.sparkSession, scratch_path(df.sparkSession, name), Observation()
    folder, _, own = path.rpartition("/")
    try:
        df.observe(counted, *(c.alias(n) for n, c in counts.items())).write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path), counted.get
    finally:
        Folders(spark, folder).remove(own)


def _sides(batch: DataFrame, passes: Column) -> tuple[int, int]:
    """Rows that pass and that fail the routing rule, in one job."""
    row = batch.agg(F.count_if(passes).alias("passed"), F.count_if(~passes).alias("failed")).first()
    return row["passed"], row["failed"]


def write_raw_batch(parsed: DataFrame, batch: str, raw_path: str, bad_path: str, *, fmt: str = "parquet") -> None:
    """Route a parsed micro-batch to the raw table and the bad-records table; skip an empty side.

    The batch is not held, however large: Spark parses only the event id to count the sides and to find the bad records, so
    one of the three passes parses whole payloads.
    """
    good, bad = _sides(parsed, identified())
    LOG.info("raw batch %s: good=%s bad=%s", batch, good, bad)
    if good:
        write_batch(good_records(parsed), raw_path, batch, fmt)
    if bad:
        write_batch(bad_records(parsed), bad_path, batch, fmt)


def upsert_batch(valid: DataFrame, batch: str, clean_path: str, *, buckets: int = BUCKETS, fmt: str = "parquet") -> int:
    """Insert the records of a batch that the clean table does not hold yet; return how many.

    They are compared with the table's key index, which the batch's own partition does not count in: a replay after a crash
    decides as the first attempt did and replaces whatever that attempt wrote. One writer per table.
    """
    spark = valid.sparkSession
    with _kept(first_per_key(valid), "candidates", rows=F.count(F.lit(1))) as (candidates, counted):
        index = KeyIndex(spark, index_path(clean_path), buckets)
        index.complete(clean_path, but=batch, fmt=fmt)
        fresh = unstored_records(candidates, index, batch_rows=counted["rows"], name=batch)
        # Joins by name move their key to the front; every batch is stored in the order of the contract.
        rows = write_batch(fresh.select(*candidates.columns), clean_path, batch, fmt)
    if rows:
        index.add(spark.read.format(fmt).load(clean_path).where(F.col(BATCH_COLUMN) == batch), [batch])
    return rows


#: A message as it was delivered: where it stood in its topic, and what it said.
_DELIVERY = ["kafka_topic", "kafka_partition", "kafka_offset", "event_id", "record_natural_key"]


def quarantine_batch(invalid: DataFrame, batch: str, path: str, *, fmt: str = "parquet") -> int:
    """Store the invalid records of a batch that no other batch has stored; return how many.

    A raw batch that is written anew after a crash is read anew: its messages stand where they stood. Beside the table, each
    batch leaves the range of offsets that it covers of each topic partition, so only batches with an overlapping range are
    compared, which are none in the usual course. The range is left first: without rows it does no harm.
    """
    spark = invalid.sparkSession
    where = ["kafka_topic", "kafka_partition"]
    ranges = invalid.groupBy(*where).agg(F.min("kafka_offset").alias("first"), F.max("kafka_offset").alias("last"))
    commits_path = path.rstrip("/") + "_commits"
    stored, commits = read_if_exists(spark, path, fmt=fmt), read_if_exists(spark, commits_path)
    ranges = written(ranges.withColumn(BATCH_COLUMN, F.lit(batch)), "offset-ranges")
    ranges.coalesce(1).write.mode("append").parquet(commits_path)
    fresh = invalid.dropDuplicates(_DELIVERY)
    if stored is not None and commits is not None:
        mine = ranges.select(*(F.col(c).alias(f"_{c}") for c in [*where, "first", "last"]))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in where]
        unnumbered = F.col("first").isNull() | F.col("_first").isNull()
        overlap = unnumbered | ((F.col("first") <= F.col("_last")) & (F.col("last") >= F.col("_first")))
        others = commits.where(F.col(BATCH_COLUMN) != batch).join(F.broadcast(mine), same[0] & same[1] & overlap, "left_semi")  # one row per topic partition
        names = others.select(BATCH_COLUMN).distinct()
        known = stored.join(F.broadcast(names), BATCH_COLUMN, "left_semi").select(*(F.col(c).alias(f"_{c}") for c in _DELIVERY)).distinct()
        equal = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _DELIVERY])
        fresh = fresh.join(known, equal, "left_anti")
    return write_batch(fresh, path, batch, fmt)


def write_clean_batch(cleaned: DataFrame, batch: str, clean_path: str, quarantine_path: str, *, fmt: str = "parquet") -> None:
    """Upsert the valid records of a micro-batch and quarantine the rest; skip an empty side."""
    passes = F.col("is_valid_record")
    with _kept(conform(cleaned, SILVER_COLUMNS, "clean layer"), "cleaned", valid=F.count_if(passes), invalid=F.count_if(~passes)) as (held, counted):
        valid, invalid = counted["valid"], counted["invalid"]
        LOG.info("clean batch %s: valid=%s invalid=%s", batch, valid, invalid)
        if valid:
            inserted = upsert_batch(valid_records(held), batch, clean_path, fmt=fmt)
            LOG.info("clean batch %s: inserted=%s", batch, inserted)
        if invalid:
            quarantine_batch(quarantined_records(held), batch, quarantine_path, fmt=fmt)


def _start(
    stream: DataFrame,
    write: Callable[[DataFrame, str], None],
    checkpoint: str,
    name: str,
    available_now: bool,
    processing_time: str,
) -> StreamingQuery:
    spark = stream.sparkSession
    require_utc(spark)

    def each(batch: DataFrame, batch_id: int) -> None:
        # The query id lives in the checkpoint: the same after a restart, new with a new checkpoint.
        # Batch numbers alone would start over and overwrite the batches of the former checkpoint.
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query_id is None:
            raise RuntimeError("the stream does not tell its query id")
        write(batch, f"{query_id}-{batch_id}")

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).queryName(name)
    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time}
    return writer.trigger(**trigger).start()


def start_raw_stream(
    messages: DataFrame,
    raw_path: str,
    bad_path: str,
    checkpoint: str,
    *,
    name: str = "messages_to_raw",
    available_now: bool = True,
    processing_time: str = PROCESSING_TIME,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Parse a message stream and land it. With ``available_now`` it stops when the backlog is done."""
    return _start(
        parse_messages(messages),
        lambda parsed, batch: write_raw_batch(parsed, batch, raw_path, bad_path, fmt=fmt),
        checkpoint,
        name,
        available_now,
        processing_time,
    )


def start_clean_stream(
    raw: DataFrame,
    clean_path: str,
    quarantine_path: str,
    checkpoint: str,
    *,
    name: str = "raw_to_clean",
    available_now: bool = True,
    processing_time: str = PROCESSING_TIME,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Clean a stream of the raw layer and upsert it."""
    return _start(
        clean(raw),
        lambda cleaned, batch: write_clean_batch(cleaned, batch, clean_path, quarantine_path, fmt=fmt),
        checkpoint,
        name,
        available_now,
        processing_time,
    )

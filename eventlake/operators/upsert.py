"""De-duplication and the insert-only upsert of the clean layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.operators.lookup import join_unique
from eventlake.session import BROADCAST_ROWS, written
from eventlake.sources.key_index import EVENT, NATURAL, KeyIndex, days_in

KEY = "record_natural_key"
ARRIVAL = ("kafka_partition", "kafka_offset", "kafka_topic", "event_id")


def first_per_key(df: DataFrame, key: str = KEY, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Keep the record that arrived first under each natural key.

    Records that share an event id but not the natural key all stay. Spark turns the rank filter into
    a group limit on both sides of the shuffle: every map task sends at most one row per key, so
    copies of one record, however many, never meet in one task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*arrival))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def _stored_among(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Distinct keys of a broadcastable batch that the target holds. Reads one column of the target."""
    wanted = batch.select(key).where(F.col(key).isNotNull()).distinct()
    return target.select(key).join(F.broadcast(wanted), key, "left_semi").distinct()


def new_records(
    batch: DataFrame,
    target: DataFrame,
    *,
    batch_rows: int,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Records of ``batch`` that match no target record by natural key or by event id.

    ``batch`` holds each natural key once, and so does ``target``. "No match on a or b" is an anti
    join on each in turn: two hash joins where one join with the OR would compare all pairs. NULL
    keys match nothing. Of the target only the two key columns are read.

    Up to ``broadcast_rows`` batch rows the batch's keys are broadcast to find those the target holds,
    which are no more; the target, however large, is not shuffled. A larger batch is joined by
    shuffling the key columns. There the target's repeated event ids collapse map-side, and event ids
    the batch repeats often are salted.
    """
    if batch_rows <= broadcast_rows:
        kept = batch
        for key in (KEY, "event_id"):
            kept = kept.join(F.broadcast(_stored_among(batch, target, key)), key, "left_anti")
        return kept
    return join_unique(
        batch.join(target.select(KEY), KEY, "left_anti"),
        target.select("event_id").where(F.col("event_id").isNotNull()).distinct(),
        "event_id",
        spread_by=KEY,
        how="left_anti",
        count_in=batch,
    )


def unstored_records(
    batch: DataFrame,
    index: KeyIndex,
    *,
    batch_rows: int,
    name: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """:func:`new_records` by the stored table's key index: the table is not read, and the index, however large, not shuffled.

    ``name``: the batch's own name; what an earlier attempt entered under it does not count. Natural keys are looked up among
    the batch's days only. The keys found are no more than the batch has; written, they are counted, and an event id that the
    batch repeats is salted where they are too many to broadcast. Beside no other batch, all of its records are new.
    """
    if not index.batches() - {name}:
        return batch
    lookup = {"rows": batch_rows, "but": name, "broadcast_rows": broadcast_rows}
    keys = batch.where(F.col(NATURAL).isNotNull()).select(F.col(NATURAL).alias("key"))
    stored = written(index.held(keys, NATURAL, days=days_in(batch), **lookup), "stored-keys")
    known = stored.count()
    right = F.broadcast(stored) if known <= broadcast_rows else stored
    unmatched = batch.join(right.withColumnRenamed("key", NATURAL), NATURAL, "left_anti")

    ids = unmatched.where(F.col(EVENT).isNotNull()).select(F.col(EVENT).alias("key")).distinct()
    found = written(index.held(ids, EVENT, **lookup), "stored-ids")
    return join_unique(
        unmatched,
        found.withColumnRenamed("key", EVENT),
        EVENT,
        spread_by=NATURAL,
        keyed_rows=found.count(),
        how="left_anti",
        broadcast_rows=broadcast_rows,
        count_in=batch,
    )

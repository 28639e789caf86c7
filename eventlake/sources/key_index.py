"""The keys that a stored table holds, kept beside it in hash buckets: what an upsert compares a batch with.

Two bucketed Parquet tables, one of natural keys with their event day, one of event ids. A lookup joins a batch's keys, dealt
to the same buckets, with the bucket files as they lie: the index is not shuffled, however large the batch, and the stored
table itself is not read. The natural key holds the event's time, so only days that occur in the batch are looked up; the
files are sorted by day, and row groups of other days are skipped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import BROADCAST_ROWS
from eventlake.sources.folders import Folders
from eventlake.sources.tables import BATCH_COLUMN, read_if_exists

NATURAL, EVENT = "record_natural_key", "event_id"
#: Buckets of a new index, and most keys of one bucket that a lookup holds in a hash table.
BUCKETS, HASHED_KEYS = 64, 2_000_000
#: Days that are named one by one in a lookup; beyond, their range is.
NAMED_DAYS = 1000
NO_DAY = "0001-01-01"

_COLUMNS = {NATURAL: "key string, day date, batch string", EVENT: "key string, batch string", "batches": "batch string"}


_GENERATION = "generation-"


def _number(generation: str) -> int:
    return int(generation[len(_GENERATION) :])


def index_path(table_path: str) -> str:
    return table_path.rstrip("/") + "_keys"


def day_of(timestamp: str = "event_timestamp") -> Column:
    """The event's day; records without a time share one of their own."""
    return F.coalesce(F.to_date(timestamp), F.lit(NO_DAY).cast("date"))


class KeyIndex:
    """The index at ``path``. ``buckets`` may not change in the life of an index, and is part of its folders' names."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.buckets = spark, buckets
        self.folders = Folders(spark, f"{path.rstrip('/')}/buckets={buckets}")
        whole = [n for n in self.folders.names() if n.startswith(_GENERATION) and self._is_whole(n)]
        self.root = f"{self.folders.root}/{max(whole, key=_number) if whole else _GENERATION + '0'}"

    def _is_whole(self, generation: str) -> bool:
        """A generation is whole once its list of batches, which is written last, is there."""
        return "_SUCCESS" in self.folders.names(f"{generation}/batches")

    def _table(self, kind: str) -> str:
        """The name under which the session's catalog knows a folder of the index; the data stays outside the warehouse."""
        path = f"{self.root}/{kind}"
        name = f"eventlake_{kind}_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
        clustered = "" if kind == "batches" else f" CLUSTERED BY (key) INTO {self.buckets} BUCKETS"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS[kind]}) USING parquet{clustered} LOCATION '{path}'")
        return name

    def keys(self, kind: str) -> DataFrame:
        name = self._table(kind)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def batches(self) -> set[str]:
        """The batches whose keys the index holds."""
        return {r[0] for r in self.keys("batches").distinct().collect()}

    def _append(self, rows: DataFrame, kind: str, *order: str) -> None:
        rows.repartition(self.buckets, "key").sortWithinPartitions(*order).write.mode("append").insertInto(self._table(kind))

    def add(self, stored: DataFrame, batches: Sequence[str]) -> None:
        """Enter the keys of stored rows, which carry their batch. A batch entered twice counts once: its rows only repeat."""
        self._append(stored.where(F.col(NATURAL).isNotNull()).select(F.col(NATURAL).alias("key"), day_of().alias("day"), BATCH_COLUMN), NATURAL, "day", "key")
        self._append(stored.where(F.col(EVENT).isNotNull()).select(F.col(EVENT).alias("key"), BATCH_COLUMN).distinct(), EVENT, "key")
        self.note(batches)

    def note(self, batches: Sequence[str]) -> None:
        """Enter batches whose keys the index holds under other names."""
        self.spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1).write.mode("append").insertInto(self._table("batches"))

    def compact(self) -> None:
        """Rewrite the index with one file for each bucket, as a new generation; its list of batches makes it the current one.

        Keys that a replay has entered twice become one. Interrupted, the old generation stays.
        """
        old = self.root
        new = KeyIndex(self.spark, self.folders.root.rsplit("/", 1)[0], self.buckets)
        generation = _GENERATION + str(_number(old.rsplit("/", 1)[1]) + 1)
        self.folders.remove(generation)  # what an interrupted attempt left
        new.root = f"{self.folders.root}/{generation}"
        for kind, order in ((NATURAL, ("day", "key")), (EVENT, ("key",))):
            new._append(self.keys(kind).distinct(), kind, *order)
        new.note(sorted(self.batches()))
        self.root = new.root
        for name in self.folders.names():
            if name.startswith(_GENERATION) and name != generation:
                self.folders.remove(name)

    def complete(self, table_path: str, *, but: str | None = None, fmt: str = "parquet") -> None:
        """Enter the batches of the table that the index does not hold: all of them for a new index, or those of a writer that
        ended between the two. ``but``: a batch about to be written anew."""
        table = read_if_exists(self.spark, table_path, fmt=fmt)
        if table is None:
            return
        stored = {part[len(BATCH_COLUMN) + 1 :] for f in table.inputFiles() for part in f.split("/") if part.startswith(BATCH_COLUMN + "=")}
        missing = sorted(stored - self.batches() - {but})
        if missing:
            self.add(table.where(F.col(BATCH_COLUMN).isin(missing)).select(NATURAL, EVENT, "event_timestamp", BATCH_COLUMN), missing)

    def held(self, wanted: DataFrame, kind: str, *, rows: int, but: str | None = None, days: Sequence[str] | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """The keys (``key``, distinct) of ``wanted`` that the index holds for batches other than ``but``.

        ``rows`` bounds the number of wanted keys: up to ``broadcast_rows`` they are broadcast, beyond they are dealt to the
        buckets, and meet them in a hash join while a bucket's keys fit, else in a merge join.
        """
        index = self.keys(kind)
        if but is not None:
            index = index.where(F.col("batch") != but)
        if days is not None:
            named = [F.lit(d).cast("date") for d in days]
            index = index.where(F.col("day").isin(named) if len(days) <= NAMED_DAYS else F.col("day").between(*named[:2]))
        if rows <= broadcast_rows:
            right = F.broadcast(wanted)
        else:
            right = wanted.repartition(self.buckets, "key").hint("shuffle_hash" if rows <= self.buckets * HASHED_KEYS else "merge")
        return index.select("key").join(right, "key", "left_semi").distinct()


def days_in(batch: DataFrame, timestamp: str = "event_timestamp") -> list[str]:
    """The days that occur in a batch; where they are too many to be named, the first and the last one come first."""
    day = day_of(timestamp).alias("day")
    days = [r[0] for r in batch.select(day).distinct().limit(NAMED_DAYS + 1).select(F.col("day").cast("string")).collect()]
    if len(days) <= NAMED_DAYS:
        return days
    ends = batch.select(day).agg(F.min("day").cast("string"), F.max("day").cast("string")).first()
    return [*ends, *days]

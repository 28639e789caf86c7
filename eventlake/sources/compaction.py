"""Many small batches of a stored table, packed into few files.

A table that streams write has one folder for each micro-batch, which a replay replaces. Only the last batch of a stream can be
replayed, so older ones are settled: their rows move to one folder of the table's sibling ``<table>_packed``, which every
batch reader of the table reads too. A stream that reads the table does not look there, so it meets no row twice; a batch that
such a stream may not have read yet must not be packed.

The rows are written to a hidden folder; a log then names it and the batches that it stands for; only then these are removed and
the folder gets its name. Whatever is interrupted is finished, or dropped, by :func:`recover`. One writer per table, and no reader
while folders change their names.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sources.folders import Folders
from eventlake.sources.tables import BATCH_COLUMN, packed_path, read_if_exists

#: Newest batches of each stream that stay as they are.
KEEP = 2
_HIDDEN, _LOG, _NAME = ".pack-", "_log", f"{BATCH_COLUMN}=pack-"


def batches_of(spark: SparkSession, path: str) -> list[str]:
    start = BATCH_COLUMN + "="
    return [n[len(start) :] for n in Folders(spark, path).names() if n.startswith(start)]


def settled(names: Iterable[str], keep: int = KEEP) -> list[str]:
    """Batches (stream id, ``-``, number) that their streams have left behind by ``keep`` others. Other names never are."""
    streams = defaultdict(list)
    for name in names:
        stream, _, number = name.rpartition("-")
        if stream and number.isdigit():
            streams[stream].append((int(number), name))
    return sorted(name for numbered in streams.values() for _, name in sorted(numbered)[: -max(1, keep)])


def _log(spark: SparkSession, path: str) -> dict[str, list[str]]:
    log = read_if_exists(spark, f"{packed_path(path)}/{_LOG}")
    return {} if log is None else {r["pack"]: r["batches"] for r in log.collect()}


def _swap(spark: SparkSession, path: str, pack: str, batches: list[str]) -> None:
    table, packs = Folders(spark, path), Folders(spark, packed_path(path))
    for batch in batches:
        table.remove(f"{BATCH_COLUMN}={batch}")
    packs.rename(_HIDDEN + pack, _NAME + pack)


def recover(spark: SparkSession, path: str) -> None:
    """Finish what an interrupted :func:`pack` has logged, drop what it has not."""
    hidden = [n[len(_HIDDEN) :] for n in Folders(spark, packed_path(path)).names() if n.startswith(_HIDDEN)]
    logged = _log(spark, path) if hidden else {}
    for pack_id in hidden:
        if pack_id in logged:
            _swap(spark, path, pack_id, logged[pack_id])
        else:
            Folders(spark, packed_path(path)).remove(_HIDDEN + pack_id)


def pack(
    spark: SparkSession,
    path: str,
    *,
    over: int = 0,
    keep: int = KEEP,
    only: Iterable[str] | None = None,
    before: Callable[[str, list[str]], None] | None = None,
    fmt: str = "parquet",
) -> list[str]:
    """Pack the settled batches if they are more than ``over``; returns them.

    ``only``: batches that may be packed, all by default. ``before(name, batches)`` enters the pack, under its new batch name,
    wherever batches are known by name; it runs before the old ones go and may run for a pack that never comes to be. Files
    get the session's advisory partition size.
    """
    recover(spark, path)
    chosen = settled(batches_of(spark, path), keep)
    if only is not None:
        allowed = set(only)
        chosen = [b for b in chosen if b in allowed]
    if len(chosen) <= over:
        return []
    pack_id = uuid.uuid4().hex
    folders = [f"{path.rstrip('/')}/{BATCH_COLUMN}={b}" for b in chosen]
    rows: DataFrame = spark.read.format(fmt).option("basePath", path).load(folders)
    rows.drop(BATCH_COLUMN).hint("rebalance").write.format(fmt).save(f"{packed_path(path)}/{_HIDDEN}{pack_id}")
    if before is not None:
        before(f"pack-{pack_id}", chosen)
    log = spark.createDataFrame([(pack_id, chosen)], "pack string, batches array<string>")
    log.coalesce(1).write.mode("append").parquet(f"{packed_path(path)}/{_LOG}")
    _swap(spark, path, pack_id, chosen)
    return chosen


def pack_quarantine(spark: SparkSession, path: str, **options) -> list[str]:
    """:func:`pack` for the quarantine: the pack covers the offset ranges of its batches."""

    def enter(name: str, batches: list[str]) -> None:
        commits = read_if_exists(spark, path.rstrip("/") + "_commits")
        if commits is not None:
            mine = commits.where(F.col(BATCH_COLUMN).isin(batches)).groupBy("kafka_topic", "kafka_partition").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            mine.withColumn(BATCH_COLUMN, F.lit(name)).coalesce(1).write.mode("append").parquet(path.rstrip("/") + "_commits")

    return pack(spark, path, before=enter, **options)

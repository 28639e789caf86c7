"""What the library needs from a session. It never changes the caller's configuration."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Most rows that are ever broadcast. At roughly 150 bytes a row this stays under 80 MB per executor.
BROADCAST_ROWS = 500_000
#: Most rows of one key that a shuffled join puts into one part. At roughly 200 bytes a row these are 200 MB.
TASK_ROWS = 1_000_000

#: Folders of local sessions without one, by application.
_OWN_FOLDERS: dict[str, str] = {}
_UTC_NAMES = {"UTC", "ETC/UTC", "GMT", "ETC/GMT", "Z", "+00:00", "UTC+00:00", "ETC/UCT", "UCT", "ZULU"}


def require_utc(spark: SparkSession) -> None:
    """Date parts and natural keys are defined in UTC, so the session zone must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in _UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach for intermediate tables (``spark.checkpoint.dir``)."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if context.applicationId not in _OWN_FOLDERS:
            _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="eventlake-")
        folder = _OWN_FOLDERS[context.applicationId]
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a table in the shared folder.

    Unlike a cache it survives the loss of executors, and unlike re-evaluating the plan it gives
    every reader the same rows even where the plan samples (range partitioning does).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

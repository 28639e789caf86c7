"""Tables on a path: existence, layer choice, guards, reads and writes.

``fmt`` is any file source the session knows. Parquet is what is tested; ``delta`` works where its
package is on the class path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.sources.folders import Folders

BATCH_COLUMN = "batch"
#: Formats that know their own columns.
SELF_DESCRIBED = {"delta"}

_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE"}


def packed_path(path: str) -> str:
    """Where the settled batches of a table are packed (see ``compaction``)."""
    return path.rstrip("/") + "_packed"


def read_if_exists(spark: SparkSession, path: str, *, fmt: str = "parquet", merge_schema: bool = False, schema: StructType | None = None) -> DataFrame | None:
    """Load a table, its packed batches included, or None where there is none yet.

    ``merge_schema`` unites the columns of appends that added some (Parquet). ``schema`` declares the columns, which then need
    not be found out from a file; formats that know their own columns ignore it.
    """
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    if schema is not None and fmt not in SELF_DESCRIBED:
        reader = reader.schema(schema)
    try:
        packed = any(n.startswith(BATCH_COLUMN + "=") for n in Folders(spark, packed_path(path)).names())
        table = reader.load(path)
        return table.unionByName(reader.load(packed_path(path)), allowMissingColumns=merge_schema) if packed else table
    except AnalysisException as error:
        if (error.getCondition() or "").split(".")[0] in _ABSENT:
            return None
        raise


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    return read_if_exists(spark, path, fmt=fmt) is not None


def read_table(spark: SparkSession, path: str, *, fmt: str = "parquet", merge_schema: bool = False, schema: StructType | None = None) -> DataFrame:
    table = read_if_exists(spark, path, fmt=fmt, merge_schema=merge_schema, schema=schema)
    if table is None:
        raise FileNotFoundError(f"no {fmt} table at {path}")
    return table


def first_existing(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """The first table that exists, e.g. the clean layer before the raw layer."""
    for path in paths:
        table = read_if_exists(spark, path, fmt=fmt)
        if table is not None:
            return table
    raise FileNotFoundError(f"none of these tables exists: {list(paths)}")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> int:
    """Write and return the row count, which is observed during the write: no second pass.

    Partitioned output is rebalanced on its partition columns first: small partitions become one
    file, and a partition that holds much of the data is split over many tasks.
    """
    counted = Observation()
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode).partitionBy(*partition_by)
    if fmt == "delta":
        writer = writer.option("overwriteSchema" if mode == "overwrite" else "mergeSchema", "true")
    writer.save(path)
    return counted.get["rows"]


def write_batch(df: DataFrame, path: str, batch: str, fmt: str = "parquet") -> int:
    """Write one micro-batch under its own partition, replacing what an earlier attempt left there.

    ``batch`` names the batch uniquely in the life of the table, e.g. stream id and batch number.

    A stream delivers a batch at least once; a replay overwrites its partition, so the table holds
    each batch exactly once.
    """
    counted = Observation()
    tagged = df.observe(counted, F.count(F.lit(1)).alias("rows")).withColumn(BATCH_COLUMN, F.lit(batch))
    writer = tagged.write.format(fmt).mode("overwrite").partitionBy(BATCH_COLUMN)
    writer.option("partitionOverwriteMode", "dynamic").save(path)
    return counted.get["rows"]

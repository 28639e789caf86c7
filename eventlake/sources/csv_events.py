"""CSV files of raw events, with the position of every row in its file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.schemas import RAW_COLUMNS

_SPLIT = ["_path", "_block", "_task"]


def scan_csv(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """The raw columns as text plus hidden columns that locate each row.

    Every file needs a header with all raw columns; further columns are ignored. ``multi_line``
    admits line breaks inside quotes at the price of reading each file in one task.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False).option("quote", '"').option("escape", '"')
    scan = reader.option("multiLine", multi_line).csv(path)
    missing = sorted(set(RAW_COLUMNS) - set(scan.columns))
    if missing:
        raise ValueError(f"{path}: missing CSV columns {missing}")
    row_id = F.monotonically_increasing_id()
    return scan.select(
        *RAW_COLUMNS,
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.shiftright(row_id, 33).alias("_task"),
        row_id.alias("_row"),
    )


def number_rows(scan: DataFrame) -> DataFrame:
    """Replace the locating columns by ``row_number``, the 1-based position in the file.

    Rows of a split are consecutive in their task, so a row's position is its distance from the
    first row of the split plus the rows of the splits before it in the file. Only one row per split
    is shuffled and sorted; the rows themselves are joined with that small table. Should the two
    passes ever see different splits, the query fails instead of numbering wrongly.
    """
    splits = scan.groupBy(*_SPLIT).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    # No hint: the number of splits grows with the data, so Spark picks the join by its size.
    joined = scan.join(starts, _SPLIT, "left")
    position = F.col("_start") + F.col("_row") - F.col("_first") + 1
    checked = F.coalesce(position, F.raise_error(F.lit("file splits changed between two passes")).cast("bigint"))
    return joined.withColumn("row_number", checked).select(*RAW_COLUMNS, "source_file", "row_number")


def read_csv_rows(spark: SparkSession, path: str, *, max_rows: int = 0, multi_line: bool = False) -> DataFrame:
    """Numbered CSV rows; ``max_rows`` keeps the first rows of each file, 0 keeps all."""
    rows = number_rows(scan_csv(spark, path, multi_line=multi_line))
    return rows.where(F.col("row_number") <= max_rows) if max_rows > 0 else rows

"""Running totals over a whole table without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.session import written

_PART = "_part"


def totals_before(df: DataFrame, order: Sequence[str | Column], amounts: Sequence[str]) -> DataFrame:
    """Add ``<amount>_before``: the sum of each amount over all rows that sort earlier.

    ``order`` must identify rows; group first when values repeat, so that no value is hot. The rows
    are range-partitioned and written, then each range adds what the ranges before it hold. Only the
    per-range sums, one row per shuffle partition, pass through a single task. The written table
    matters: range bounds are sampled, and both readers below must see the same ranges.
    """
    ranged = df.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id())
    ranged = written(ranged, "ranges")

    earlier_rows = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier_parts = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(_PART).agg(*(F.sum(a).alias(f"_{a}") for a in amounts))
    starts = sums.select(
        _PART, *(F.coalesce(F.sum(f"_{a}").over(earlier_parts), F.lit(0)).alias(f"_{a}_start") for a in amounts)
    )

    def before(amount: str) -> Column:
        return F.col(f"_{amount}_start") + F.coalesce(F.sum(amount).over(earlier_rows), F.lit(0))

    joined = ranged.join(F.broadcast(starts), _PART)  # one row per shuffle partition
    return joined.withColumns({f"{a}_before": before(a) for a in amounts}).drop(
        _PART, *(f"_{a}_start" for a in amounts)
    )


def frequency_index(df: DataFrame, column: str, output: str) -> DataFrame:
    """One row per distinct value with its rank by falling frequency, ties by value, from 0.0."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).withColumn("one", F.lit(1))
    ranked = totals_before(counts, [F.desc("n"), F.asc(column)], ["one"])
    return ranked.select(column, F.col("one_before").cast("double").alias(output))

"""Ranks and running values within keys of any size: sorted ranges of a written table, and what the ranges before add."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import written

_PLACE_BITS = 33  # of monotonically_increasing_id


def in_ranges(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Written, sorted by ``order`` over all of its ranges: adds ``part``, the range, and ``place`` in it, both from 0.

    A key with many rows lies in several ranges. The ranges are sampled, so all readers need the written table.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(rows.withColumns({"part": F.spark_partition_id(), "place": place}), name)


def key_segments(rows: DataFrame, key: str) -> DataFrame:
    """One row for each key and range: ``part``, the key, ``first`` (its first place there), ``size`` (its rows in all ranges) and
    ``before`` (its rows in earlier ranges). A key has one for each range that holds it, at most as many as there are ranges.

    A row's rank in its key is ``before + place - first``.
    """
    counted = rows.groupBy("part", key).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(key)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("part", key, "first", F.sum("n").over(whole).alias("size"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

"""What several operators of the subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import written

__all__ = ["components", "table", "text_of", "written", "arrow_schema", "chunks"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def arrow_schema(**types: pa.DataType) -> pa.Schema:
    return pa.schema(list(types.items()))


def chunks(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of ``column`` each, one row at least."""
    lengths = batch.column(column)
    start = size = 0
    for row, value in enumerate(lengths):
        size += len(value.as_buffer() if value.is_valid else b"")
        if size >= limit:
            yield batch.slice(start, row + 1 - start)
            start, size = row + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``links`` (a, b: long): ``node`` and ``root``, the smallest node reachable.

    Each round a node takes the smallest root among its neighbours and then the root of that root, so a
    path of length d needs about log d rounds. A round is written to the shared folder: executors may be
    lost and the plan stays short. A hub's neighbours are combined before they are shuffled.
    """
    ways = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-links")
    labels = written(ways.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), name)
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("root").alias("r"))
        nearest = ways.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("r").alias("r"))
        lowered = labels.join(nearest, "node").select("node", F.col("root").alias("old"), F.least("root", "r").alias("root"))
        roots = labels.select(F.col("node").alias("root"), F.col("root").alias("r"))
        jumped = lowered.join(roots, "root").select("node", "old", F.least("root", "r").alias("root"))
        step = written(jumped, name)
        labels = step.select("node", "root")
        if step.where("root <> old").isEmpty():
            return labels

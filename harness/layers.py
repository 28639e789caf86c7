"""The stored layers that the queries start from, as the jobs do: each reads the layer below it.

A layer is derived from the ``events`` test table once per session and table folder, written to the
shared folder with the library's own writer, and read back by every query that needs it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventlake.operators import gold, silver
from eventlake.operators.bronze import identified
from eventlake.schemas import FEATURE_COLUMNS, SILVER_COLUMNS
from eventlake.session import scratch_path
from eventlake.sources.tables import read_table, write_table
from harness import fixtures

_PATHS: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], object]) -> str:
    """Path below which ``make`` has put its tables, made on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _PATHS:
        path = scratch_path(spark, name)
        make(path)
        _PATHS[key] = path
    return _PATHS[key]


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], partition_by: tuple[str, ...] = ()) -> DataFrame:
    return read_table(spark, once(spark, sf_dir, name, lambda path: write_table(build(), path, partition_by=partition_by)))


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records as they were sent, those without an event id included."""
    return _stored(spark, sf_dir, "source", lambda: fixtures.raw_events(spark, sf_dir))


def raw_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_rows(spark, sf_dir).where(identified())


def clean_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda: silver.clean(raw_layer(spark, sf_dir)).select(*SILVER_COLUMNS)
    return _stored(spark, sf_dir, "clean", build)


def feature_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda: gold.feature_table(clean_layer(spark, sf_dir))
    return _stored(spark, sf_dir, "features", build, ("year",)).select(*FEATURE_COLUMNS)

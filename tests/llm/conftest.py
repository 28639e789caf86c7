from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())])


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(*rows):
        full = [(*r, "en", "a")[:4] if len(r) == 2 else r for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest test tables, as Python rows."""

    def rows(name, *columns):
        return [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").select(*columns).collect()]

    return rows


@pytest.fixture(scope="session")
def run(spark):
    """A registered query's rows over the smallest test tables."""
    from eventlake.llm import queries

    def call(name):
        return queries.queries()[name](spark, "/root/testdata/sf0.001").collect()

    return call


EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, "word " * 40_000)]


@pytest.fixture
def edges():
    """NULL, empty, blank, repeated and very long texts, repeated rows, NULL keys."""
    return EDGES

"""The feature vectors that all estimators of a task read: one state index, one stored vector table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.lookup import join_unique
from eventlake.operators.ranking import frequency_index

STATE_INDEX = "state_index_model"
#: A table of vectors with fewer rows for each core is dealt to as many files as there are cores: its bytes would be few splits, of
#: which some cores get one more than others. Vectors of two million rows are about one split.
ROWS_PER_CORE = 10_000_000
#: Categories that the tree models take; their ``maxBins``.
MAX_CATEGORIES = 128


def spread(vectors: DataFrame, rows: int, rows_per_core: int = ROWS_PER_CORE) -> DataFrame:
    """Vectors of about so many ``rows``, to be written so that every core gets a part of them to train on or to score."""
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return vectors.repartition(cores) if rows < cores * rows_per_core else vectors


def state_index(train: DataFrame) -> DataFrame:
    """One row per state of the training part: its rank by falling frequency. States are ranked and joined, never collected."""
    return frequency_index(train.where(F.col("state").isNotNull()), "state", STATE_INDEX)


def with_vector(data: DataFrame, index: DataFrame, numbers: Sequence[str], *, states: int) -> DataFrame:
    """Adds the state's index and ``features``: the numbers in order, then the index. Rows with a missing number are left out.

    A state without an index, or a NULL one, gets the next number (``states``). While the states fit into the trees' bins the
    index is a category to them; more states are an ordered number, most frequent first.
    """
    joined = join_unique(data, index, "state", spread_by="event_id", keyed_rows=states)
    number = F.coalesce(F.col(STATE_INDEX), F.lit(float(states)))
    kind = {"type": "nominal", "num_vals": states + 1} if states < MAX_CATEGORIES else {"type": "numeric"}
    indexed = joined.withColumn(STATE_INDEX, number).withMetadata(STATE_INDEX, {"ml_attr": {**kind, "name": STATE_INDEX}})
    return VectorAssembler(inputCols=[*numbers, STATE_INDEX], outputCol="features", handleInvalid="skip").transform(indexed)

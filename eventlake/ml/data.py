"""Training frames, train/test split and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.silver import UNKNOWN_STATE

# Model inputs in vector order, split share and seed, smallest training set.
REGRESSION_FEATURES = ["latitude", "longitude", "depth", "significance", "month", "hour", "tsunami"]
CLASSIFICATION_FEATURES = ["latitude", "longitude", "depth", "magnitudo", "significance", "month", "hour"]
TRAIN_SHARE = 0.8
SEED = 42
MIN_ROWS = 100

_HASH_RANGE = 2**32


def _doubles(columns: list[str]) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in columns]


def _state() -> Column:
    return F.coalesce("state", F.lit(UNKNOWN_STATE)).alias("state")


def regression_data(features: DataFrame) -> DataFrame:
    """Columns for the magnitude models where all of them are known (neither NULL nor NaN)."""
    numbers = [*REGRESSION_FEATURES, "magnitudo"]
    return features.select("event_id", _state(), *_doubles(numbers)).dropna(subset=[*numbers, "state"])


def classification_data(risk_set: DataFrame) -> DataFrame:
    """Columns for the tsunami models where all are known and the label is 0 or 1."""
    label = F.col("tsunami").cast("double").alias("label")
    data = risk_set.select("event_id", _state(), "tsunami", *_doubles(CLASSIFICATION_FEATURES), label)
    return data.dropna(subset=["label", *CLASSIFICATION_FEATURES, "state"]).where(F.col("label").isin(0.0, 1.0))


def in_train_part(id_column: str = "event_id", share: float = TRAIN_SHARE, seed: int = SEED) -> Column:
    """Whether a record belongs to the training part, decided by a hash of its id.

    The same record always falls on the same side, however the data is partitioned.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string")))
    position = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return position < F.lit(int(share * _HASH_RANGE))


def split(data: DataFrame, *, share: float = TRAIN_SHARE, seed: int = SEED, by_hash: bool = True) -> tuple[DataFrame, DataFrame]:
    """Train and test part, both read from ``data``: hold it if it is costly to compute.

    ``by_hash=False`` uses ``randomSplit``, which depends on the partitioning.
    """
    if not by_hash:
        train, test = data.randomSplit([share, 1.0 - share], seed=seed)
        return train, test
    chosen = in_train_part(share=share, seed=seed)
    return data.where(chosen), data.where(~chosen)


def class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class: all rows / (number of classes * rows of the class). One row per class."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    # One entry per class; the label is binary.
    entries = F.collect_list(F.struct(label, "count"))
    classes = counts.agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("classes"), entries.alias("entries"))
    weight = F.col("total") / (F.col("classes") * F.col("count"))
    return classes.select("total", "classes", F.inline("entries")).select(label, "count", weight.alias("class_weight"))


def with_class_weights(train: DataFrame, weights: dict[float, float], label: str = "label") -> DataFrame:
    """Attach weights, 1.0 for a class without one. Fails unless there are two classes."""
    if len(weights) < 2:
        raise ValueError(f"classification needs two classes, found {sorted(weights)}")
    known = [F.when(F.col(label) == c, F.lit(float(w))) for c, w in sorted(weights.items())]
    return train.withColumn("class_weight", F.coalesce(*known, F.lit(1.0)))

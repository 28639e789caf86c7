"""Scoring of the feature table with the best run of an experiment."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.ml.models import StoredModel
from eventlake.ml.runs import best_run
from eventlake.ml.training import CLASSIFICATION, Task
from eventlake.ml.vectors import spread
from eventlake.sources.tables import require_rows, write_table


def second_probability(scored: DataFrame) -> Column:
    """Probability of class 1, NULL for a model that gives none."""
    if "probability" not in scored.columns:
        return F.lit(None).cast("double")
    return F.get(vector_to_array("probability"), F.lit(1))


def predict(task: Task, features: DataFrame, runs: DataFrame, *, predicted_at: str | None = None) -> DataFrame | None:
    """Predictions of the best run, or None without a run. Rows with a missing input are skipped.

    A feature row is few bytes and costs a forest much: every core gets some, however few files the table has.
    """
    run = best_run(runs, task.experiment, task.order_metric, ascending=task.ascending)
    if run is None:
        return None
    stamp = predicted_at or datetime.now(timezone.utc).replace(tzinfo=None).isoformat() + "Z"
    stored = StoredModel(features.sparkSession, run["artifact_uri"])
    scored = stored.model.transform(spread(stored.with_vector(features), int(run["params"].get("data_row_count", 0))))
    extra = [second_probability(scored).alias("probability_tsunami")] if task is CLASSIFICATION else []
    return scored.select(
        "event_id",
        F.col("prediction").cast("double").alias("prediction"),
        *extra,
        F.lit(task.experiment).alias("model_name"),
        F.lit(run["run_id"]).alias("run_id"),
        F.lit(run["run_id"]).alias("model_version"),
        F.lit(stamp).alias("predicted_at"),
    )


def write_predictions(task: Task, features: DataFrame, runs: DataFrame, path: str, fmt: str = "parquet") -> int | None:
    """Overwrite the prediction table; returns the row count, or None without a run."""
    predictions = predict(task, require_rows(features, "feature table"), runs)
    return None if predictions is None else write_table(predictions, path, fmt=fmt)

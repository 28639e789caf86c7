"""Training of both model families: split, fit, evaluate, log, save."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.ml.data import MIN_ROWS, SEED, TRAIN_SHARE, class_weights, split, with_class_weights
from eventlake.ml.metrics import classification_metrics, confusion_matrix, curve_auc, regression_metrics
from eventlake.ml.models import CLASSIFIERS, REGRESSORS, explain, fit_stored, hyperparameters, input_columns
from eventlake.ml.runs import append_run, write_csv
from eventlake.ml.vectors import spread, state_index, with_vector
from eventlake.session import written

SAMPLE_ROWS = 100


@dataclass(frozen=True)
class Task:
    """What sets the two model families apart."""

    experiment: str
    target: str
    label: str
    models: tuple[str, ...]
    order_metric: str
    ascending: bool
    sample_columns: tuple[str, ...]


REGRESSION = Task(
    experiment="magnitude_regression",
    target="magnitudo",
    label="magnitudo",
    models=tuple(REGRESSORS),
    order_metric="rmse",
    ascending=True,
    sample_columns=("event_id", "state", "magnitudo", "prediction", "latitude", "longitude", "depth", "significance"),
)
CLASSIFICATION = Task(
    experiment="tsunami_classification",
    target="tsunami",
    label="label",
    models=tuple(CLASSIFIERS),
    order_metric="f1",
    ascending=False,
    sample_columns=("event_id", "state", "label", "prediction", "latitude", "longitude", "depth", "magnitudo", "significance"),
)


def evaluate(task: Task, predictions: DataFrame) -> dict[str, float]:
    if task is REGRESSION:
        return regression_metrics(predictions).first().asDict()
    scores = classification_metrics(confusion_matrix(predictions)).first().asDict()
    return {**scores, "roc_auc": curve_auc(predictions)}


def prediction_sample(task: Task, predictions: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    return predictions.select(*task.sample_columns).orderBy("event_id").limit(rows)


def _write_diagnostics(task: Task, folder: str, fitted: Model, model_name: str, predictions: DataFrame) -> None:
    spark = predictions.sparkSession
    write_csv(spark.createDataFrame(explain(fitted, model_name), "feature string, kind string, value double"), f"{folder}/feature_importance_or_coefficients")
    write_csv(prediction_sample(task, predictions), f"{folder}/prediction_sample")
    if task is CLASSIFICATION:
        write_csv(confusion_matrix(predictions), f"{folder}/confusion_matrix")


def train(
    task: Task,
    data: DataFrame,
    folder: str,
    *,
    models: Sequence[str] | None = None,
    changes: Mapping[str, dict] | None = None,
    share: float = TRAIN_SHARE,
    seed: int = SEED,
    by_hash: bool = True,
) -> list[dict]:
    """Train, evaluate, save and log each model; the best comes first in the result.

    ``changes`` holds hyperparameters to replace, by model name.

    Below ``folder`` stand ``runs`` (the run table), ``models/<run id>`` and ``diagnostics/<run id>``.
    The states are indexed once and the vectors of both parts stored once; every estimator reads the same table.
    """
    spark = data.sparkSession
    held = [data.persist(StorageLevel.MEMORY_AND_DISK)]
    train_part, test_part = split(data, share=share, seed=seed, by_hash=by_hash)
    try:
        train_rows, test_rows = train_part.count(), test_part.count()
        if train_rows + test_rows < MIN_ROWS:
            raise ValueError(f"{task.experiment}: {train_rows + test_rows} rows, needs {MIN_ROWS}")
        if not (train_rows and test_rows):
            raise ValueError(f"{task.experiment}: {train_rows} rows to train on and {test_rows} to test with, needs some of each")
        shared = {
            "train_test_split": share,
            "data_row_count": train_rows + test_rows,
            "train_row_count": train_rows,
            "test_row_count": test_rows,
        }
        if task is CLASSIFICATION:
            classes = class_weights(train_part).collect()  # one row per class
            weights = {float(r["label"]): r["class_weight"] for r in classes}
            shared["class_distribution"] = {float(r["label"]): r["count"] for r in data.groupBy("label").count().collect()}
            shared["class_weights"] = weights
            train_part = with_class_weights(train_part, weights)

        chosen = models or task.models
        index = written(state_index(train_part), "state-index")
        numbers, states = input_columns(chosen[0])[:-1], index.count()
        parts = (train_part, train_rows), (test_part, test_rows)
        train_part, test_part = (written(spread(with_vector(p, index, numbers, states=states), n), "vectors") for p, n in parts)
        held.pop().unpersist()
        results = []
        for model_name in chosen:
            run_id, started = uuid.uuid4().hex, datetime.now(timezone.utc)
            artifact, changed = f"{folder}/models/{run_id}", (changes or {}).get(model_name, {})
            stored = fit_stored(model_name, train_part, index, artifact, seed, **changed)
            predictions = stored.model.transform(test_part).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(predictions)
            metrics = evaluate(task, predictions)
            _write_diagnostics(task, f"{folder}/diagnostics/{run_id}", stored.model, model_name, predictions)
            predictions.unpersist()
            append_run(
                spark,
                f"{folder}/runs",
                {
                    "run_id": run_id,
                    "experiment": task.experiment,
                    "status": "FINISHED",
                    "start_time": started,
                    "end_time": datetime.now(timezone.utc),
                    "artifact_uri": artifact,
                    "params": {
                        "model_name": model_name,
                        **shared,
                        **hyperparameters(model_name),
                        **changed,
                        "features": ",".join(input_columns(model_name)),
                    },
                    "metrics": metrics,
                    "tags": {"model_family": task.experiment.split("_")[1], "target": task.target},
                },
            )
            results.append({"model_name": model_name, "run_id": run_id, **metrics})
    finally:
        for frame in held:
            frame.unpersist()
    sign = 1 if task.ascending else -1
    return sorted(results, key=lambda r: sign * r[task.order_metric])

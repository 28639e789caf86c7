"""The seven estimators, the form in which they are stored, and what a fitted one says about its inputs."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession

from eventlake.ml.data import CLASSIFICATION_FEATURES, REGRESSION_FEATURES, SEED
from eventlake.ml.vectors import STATE_INDEX, with_vector

# Model names and hyperparameters.
REGRESSORS = {
    "linear_regression_baseline": (LinearRegression, {"maxIter": 50, "regParam": 0.05, "elasticNetParam": 0.0}),
    "decision_tree_regressor": (DecisionTreeRegressor, {"maxDepth": 8, "maxBins": 128}),
    "random_forest_regressor": (
        RandomForestRegressor,
        {"numTrees": 80, "maxDepth": 8, "maxBins": 128, "minInstancesPerNode": 2, "subsamplingRate": 0.8},
    ),
    "gbt_regressor": (GBTRegressor, {"maxIter": 50, "maxDepth": 6, "maxBins": 128}),
    "generalized_linear_regression": (
        GeneralizedLinearRegression,
        {"family": "gaussian", "link": "identity", "maxIter": 50, "regParam": 0.05},
    ),
}
CLASSIFIERS = {
    "logistic_regression_baseline": (LogisticRegression, {"maxIter": 60, "regParam": 0.05, "elasticNetParam": 0.0}),
    "random_forest_classifier": (
        RandomForestClassifier,
        {"numTrees": 100, "maxDepth": 8, "maxBins": 128, "minInstancesPerNode": 2, "subsamplingRate": 0.8},
    ),
}


def input_columns(model_name: str) -> list[str]:
    """Vector order of a model's inputs."""
    numbers = REGRESSION_FEATURES if model_name in REGRESSORS else CLASSIFICATION_FEATURES
    return [*numbers, STATE_INDEX]


def hyperparameters(model_name: str) -> dict:
    return dict({**REGRESSORS, **CLASSIFIERS}[model_name][1])


def estimator(model_name: str, seed: int = SEED, **changes) -> Estimator:
    """The estimator with its fixed hyperparameters; ``changes`` replace some of them."""
    catalog = {**REGRESSORS, **CLASSIFIERS}
    if model_name not in catalog:
        raise ValueError(f"unknown model {model_name}, known are {sorted(catalog)}")
    kind, settings = catalog[model_name]
    columns = {"featuresCol": "features", "labelCol": "magnitudo"}
    if model_name in CLASSIFIERS:
        columns |= {"labelCol": "label", "weightCol": "class_weight"}
    # A forest's trees know where a row has got to; else each level leads every row down every tree from the root.
    work = {"cacheNodeIds": True} if "numTrees" in settings else {}
    model = kind(**columns, **{**work, **settings, **changes})
    return model.setSeed(seed) if model.hasParam("seed") else model


class StoredModel:
    """A fitted model and its state index, as stored below ``path``. It scores rows that have the states' names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path, self.index = path, spark.read.parquet(f"{path}/state_index")
        self.states = self.index.count()
        self.model: Model = PipelineModel.load(f"{path}/model").stages[0]

    @property
    def numbers(self) -> list[str]:
        return CLASSIFICATION_FEATURES if self.model.hasParam("probabilityCol") else REGRESSION_FEATURES

    def with_vector(self, rows: DataFrame) -> DataFrame:
        return with_vector(rows, self.index, self.numbers, states=self.states)

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds the prediction; rows with a missing input get none."""
        return self.model.transform(self.with_vector(rows))


def fit_stored(model_name: str, vectors: DataFrame, index: DataFrame, path: str, seed: int = SEED, **changes) -> StoredModel:
    """Fit on rows that have their vectors, save, and return the model as saved.

    The fitted object itself keeps a training summary that refers to the session, which can make its
    ``transform`` unserialisable once the session has observed a query. The saved model has none.
    """
    fitted = estimator(model_name, seed, **changes).fit(vectors)
    PipelineModel([fitted]).write().overwrite().save(f"{path}/model")
    index.write.mode("overwrite").parquet(f"{path}/state_index")
    return StoredModel(vectors.sparkSession, path)


#: What explains a model: the name of the quantity, and the attributes that hold it and its constant term.
_LINEAR, _TREES = ("coefficient", "coefficients", "intercept"), ("importance", "featureImportances", None)
EXPLAINED = {
    "linear_regression_baseline": _LINEAR,
    "generalized_linear_regression": _LINEAR,
    "logistic_regression_baseline": _LINEAR,
}


def explain(model: Model, model_name: str) -> list[dict]:
    """One row per input of the model: ``feature, kind, value``; the constant term of a linear model is a row too.

    A model that holds neither quantity gets one row that says so, without a value.
    """
    kind, values, constant = EXPLAINED.get(model_name, _TREES)
    if not hasattr(model, values):
        return [{"feature": "not_available", "kind": model_name, "value": None}]
    row = lambda feature, value: {"feature": feature, "kind": kind, "value": float(value)}
    rows = list(map(row, input_columns(model_name), getattr(model, values).toArray()))
    return rows if constant is None else [*rows, row(constant, getattr(model, constant))]

import csv
import math
import random
from datetime import datetime
from glob import glob

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from eventlake.ml import certificates, data, inference, metrics, runs, training
from eventlake.ml.models import CLASSIFIERS, REGRESSORS, StoredModel, estimator, explain, fit_stored, hyperparameters, input_columns
from eventlake.ml.training import CLASSIFICATION, REGRESSION, train
from eventlake.ml.vectors import STATE_INDEX, spread, state_index, with_vector
from eventlake.session import written
from tests.helpers import plan


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        depth, significance = rng.random() * 600, rng.randrange(900)
        rows.append((
            f"e{i}", rng.choice(["A", "B", "C", None]), rng.random() * 180 - 90, rng.random() * 360 - 180, depth, significance,
            rng.randrange(1, 13), rng.randrange(24), int(significance > 600), 3 + significance / 200 + rng.random() / 10,
        ))
    schema = "event_id string, state string, latitude double, longitude double, depth double, significance int, month int, hour int, tsunami int, magnitudo double"
    return spark.createDataFrame(rows, schema).repartition(4).persist()


def test_training_frames(spark, features):
    holes = features.limit(1).withColumns({"event_id": F.lit("nan"), "depth": F.lit(float("nan"))})
    holes = holes.unionByName(features.limit(1).withColumns({"event_id": F.lit("two"), "tsunami": F.lit(2)}))
    frame = data.regression_data(features.unionByName(holes))
    assert frame.count() == 401 and frame.where("state = 'unknown'").count() > 0
    assert data.classification_data(features.unionByName(holes)).count() == 400
    assert set(input_columns("gbt_regressor")) - set(input_columns("random_forest_classifier")) == {"tsunami"}


def test_split_does_not_depend_on_partitioning(features):
    train_part, test_part = data.split(features)
    ids = {r[0] for r in train_part.select("event_id").collect()}
    assert len(ids) + test_part.count() == 400 and 280 < len(ids) < 360
    assert ids == {r[0] for r in data.split(features.repartition(9))[0].select("event_id").collect()}
    assert ids != {r[0] for r in data.split(features, seed=43)[0].select("event_id").collect()}
    assert sum(p.count() for p in data.split(features, by_hash=False)) == 400


def test_class_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 6 + [(1.0,)] * 2, "label double")
    weights = {r["label"]: r["class_weight"] for r in data.class_weights(df).collect()}
    assert weights == {0.0: 8 / 12, 1.0: 2.0}
    weighted = data.with_class_weights(df.union(spark.createDataFrame([(7.0,)], "label double")), weights)
    assert {r["label"]: r["class_weight"] for r in weighted.distinct().collect()} == {**weights, 7.0: 1.0}
    with pytest.raises(ValueError, match="two classes"):
        data.with_class_weights(df, {0.0: 1.0})


def test_metrics_equal_the_evaluators(spark):
    rng = random.Random(2)
    rows = [(float(rng.random() < 0.2), float(rng.random() < 0.4), rng.randrange(50) / 50, rng.random()) for _ in range(1500)]
    df = spark.createDataFrame(rows, "label double, prediction double, score double, magnitudo double").repartition(5)
    got = metrics.classification_metrics(metrics.confusion_matrix(df)).first()
    for ours, theirs in {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}.items():
        assert got[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df), abs=1e-12)
    regression = metrics.regression_metrics(df).first()
    for name in ("rmse", "mae", "r2"):
        assert regression[name] == pytest.approx(RegressionEvaluator(labelCol="magnitudo", metricName=name).evaluate(df), abs=1e-12)
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert metrics.roc_auc(df).first()["roc_auc"] == pytest.approx(exact, abs=1e-12)
    assert metrics.roc_auc(df.where("label = 1")).first()["roc_auc"] is None
    assert math.isnan(metrics.curve_auc(df))
    assert metrics.regression_metrics(df.withColumn("magnitudo", F.lit(1.0))).first()["r2"] is None


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 1.0)], "label double, prediction double")
    got = metrics.classification_metrics(metrics.confusion_matrix(df)).first()
    for ours, theirs in {"precision": "weightedPrecision", "f1": "f1"}.items():
        assert got[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df))


def test_hyperparameters_reach_the_estimators():
    forest = estimator("random_forest_regressor")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins(), forest.getSeed()) == (80, 8, 128, 42)
    assert estimator("random_forest_classifier").getNumTrees() == 100
    changed = estimator("random_forest_regressor", numTrees=50, maxDepth=6)
    assert (changed.getNumTrees(), changed.getMaxDepth(), changed.getMaxBins()) == (50, 6, 128)
    assert estimator("logistic_regression_baseline").getWeightCol() == "class_weight"
    assert estimator("gbt_regressor").getMaxIter() == 50 and estimator("decision_tree_regressor").getMaxDepth() == 8
    assert estimator("generalized_linear_regression").getLink() == "identity"
    assert len(REGRESSORS) == 5 and len(CLASSIFIERS) == 2
    with pytest.raises(ValueError, match="unknown model"):
        estimator("other")


def test_train_log_and_score(spark, features, lake):
    best = train(REGRESSION, data.regression_data(features), f"{lake}/r", models=["linear_regression_baseline", "decision_tree_regressor"], changes={"decision_tree_regressor": {"maxDepth": 4}})
    assert best[0]["rmse"] <= best[1]["rmse"] < 1
    log = runs.read_runs(spark, f"{lake}/r/runs")
    top = runs.best_run(log, "magnitude_regression", "rmse", ascending=True)
    assert top["run_id"] == best[0]["run_id"] and top["params"]["data_row_count"] == "400"
    assert int(top["params"]["train_row_count"]) + int(top["params"]["test_row_count"]) == 400

    depths = [r["params"].get("maxDepth") for r in log.collect()]
    assert sorted(d for d in depths if d) == ["4"]

    holed = features.withColumn("depth", F.when(F.col("event_id") != "e0", F.col("depth")))
    scored = inference.predict(REGRESSION, holed, log)
    assert scored.columns == ["event_id", "prediction", "model_name", "run_id", "model_version", "predicted_at"]
    assert scored.count() == 399
    assert inference.write_predictions(REGRESSION, features, log, f"{lake}/predictions") == 400
    assert inference.predict(CLASSIFICATION, features, log) is None
    with pytest.raises(ValueError, match="empty"):
        inference.write_predictions(REGRESSION, features.limit(0), log, f"{lake}/predictions")

    sample = glob(f"{lake}/r/diagnostics/{top['run_id']}/prediction_sample/*.csv")
    with open(sample[0], newline="") as file:
        assert len(list(csv.DictReader(file))) == int(top["params"]["test_row_count"])


def test_classification_end_to_end(spark, features, lake):
    risk = data.classification_data(features)
    (result,) = train(CLASSIFICATION, risk, lake, models=["logistic_regression_baseline"])
    assert result["f1"] > 0.8 and result["roc_auc"] > 0.9
    scored = inference.predict(CLASSIFICATION, features, runs.read_runs(spark, f"{lake}/runs"), predicted_at="now")
    assert scored.where("probability_tsunami BETWEEN 0 AND 1").count() == 400
    assert scored.where("(probability_tsunami > 0.5) <> (prediction = 1)").count() == 0
    with pytest.raises(ValueError, match="two classes"):
        train(CLASSIFICATION, risk.where("label = 0"), lake, models=["logistic_regression_baseline"])
    with pytest.raises(ValueError, match="needs 100"):
        train(REGRESSION, data.regression_data(features.limit(20)), lake)


def fitted(features, name, folder, **changes):
    frame = data.regression_data(features)
    index = state_index(frame)
    vectors = with_vector(frame, index, input_columns(name)[:-1], states=index.count())
    return vectors, fit_stored(name, vectors, index, f"{folder}/{name}", **changes)


def test_explanations(features, lake):
    linear = explain(fitted(features, "linear_regression_baseline", lake)[1].model, "linear_regression_baseline")
    assert [r["feature"] for r in linear] == [*input_columns("linear_regression_baseline"), "intercept"]
    tree = explain(fitted(features, "decision_tree_regressor", lake)[1].model, "decision_tree_regressor")
    assert sum(r["value"] for r in tree) == pytest.approx(1)
    assert explain(object(), "linear_regression_baseline") == [{"feature": "not_available", "kind": "linear_regression_baseline", "value": None}]


def test_states_are_indexed_as_the_string_indexer_does(spark, features):
    frame = data.regression_data(features)
    index = state_index(frame)
    expected = StringIndexer(inputCol="state", outputCol="i", handleInvalid="keep").fit(frame)
    new = frame.unionByName(frame.limit(1).withColumns({"state": F.lit("never seen"), "event_id": F.lit("new")}))
    new = new.unionByName(frame.limit(1).withColumns({"state": F.lit(None).cast("string"), "event_id": F.lit("none")}))
    got = {r["event_id"]: r[STATE_INDEX] for r in with_vector(new, index, ["depth"], states=index.count()).collect()}
    assert got == {r["event_id"]: r["i"] for r in expected.transform(new).collect()}


@pytest.mark.parametrize("states, kind", [(100, "nominal"), (300, "numeric")])
def test_any_number_of_states_can_be_learned(spark, lake, states, kind):
    rows = spark.range(1200).selectExpr("concat('e', id) event_id", f"concat('s', id % {states}) state", *(f"CAST(id % 17 AS double) {c}" for c in data.REGRESSION_FEATURES), "CAST(id % 5 AS double) magnitudo")
    index = state_index(rows)
    vectors = with_vector(rows, index, data.REGRESSION_FEATURES, states=index.count())
    assert kind in vectors.schema["features"].metadata["ml_attr"]["attrs"] and "CollectLimit" not in plan(vectors)
    stored = fit_stored("decision_tree_regressor", vectors, index, f"{lake}/m")
    assert stored.states == states and stored.transform(rows).count() == 1200


def test_one_index_and_one_vector_table_for_all_estimators(spark, features, lake, monkeypatch):
    made, tables, fit = [], [], training.fit_stored
    monkeypatch.setattr(training, "state_index", lambda rows: made.append(1) or state_index(rows))
    monkeypatch.setattr(training, "fit_stored", lambda name, vectors, *a, **k: tables.append(tuple(vectors.inputFiles())) or fit(name, vectors, *a, **k))
    small = {"random_forest_regressor": {"numTrees": 3}, "gbt_regressor": {"maxIter": 2}}
    assert len(train(REGRESSION, data.regression_data(features), lake, changes=small)) == 5
    assert made == [1] and len(tables) == 5 and len(set(tables)) == 1 and tables[0]


def holds(rows):
    return {(r["kind"], r["name"]): r["holds"] for r in rows.collect()}


def test_certificates_tell_a_fitted_model_from_a_changed_one(spark, features, lake):
    name = "linear_regression_baseline"
    vectors, stored = fitted(features, name, lake)
    assert set(holds(certificates.optimality(stored, name, vectors, label="magnitudo")).values()) == {True}
    other = fitted(features, "generalized_linear_regression", lake, regParam=0.06)[1]
    assert False in holds(certificates.optimality(other, "generalized_linear_regression", vectors, label="magnitudo")).values()

    for name, changes in (("decision_tree_regressor", {}), ("gbt_regressor", {"maxIter": 4})):
        vectors, stored = fitted(features, name, lake, **changes)
        assert set(holds(certificates.node_rules(stored, name)).values()) == {True}
        assert set(holds(certificates.leaf_rules(stored, name, vectors, "magnitudo")).values()) == {True}
        moved = vectors.withColumn("magnitudo", F.col("magnitudo") + (F.col("event_id") == "e3").cast("double"))
        assert not any(holds(certificates.leaf_rules(stored, name, moved, "magnitudo")).values())
        again = certificates.relational_predictions(stored, vectors, name)
        told = stored.model.transform(vectors).select("event_id", "prediction").join(again, "event_id")
        assert told.where("abs(prediction - recomputed) > 1e-9").isEmpty() and told.count() == 400
    nodes = certificates.node_table(StoredModel(spark, f"{lake}/decision_tree_regressor"))
    assert nodes.where("id = 0").count() == 1 and nodes.where("left >= 0 AND gain < 0").isEmpty()


def test_rows_go_down_the_trees_where_they_lie(spark, features, lake):
    """No row for each tree, no join for each level; repeated keys and splits by category too."""
    vectors, stored = fitted(features, "gbt_regressor", lake, maxIter=4, maxDepth=4)
    vectors = written(vectors, "vectors")
    again = certificates.relational_predictions(stored, vectors, "gbt_regressor")
    assert "Join" not in plan(again) and "Generate" not in plan(again)
    assert "Join" not in plan(certificates.tree_values(stored, vectors, "event_id")) and "Exchange" not in plan(certificates.tree_values(stored, vectors.select("event_id", "features"), "event_id"))
    by_state = vectors.withColumn("magnitudo", F.when(F.col(STATE_INDEX).isin(0.0, 2.0), 1.0).otherwise(5.0) + F.col("depth") / 1e6)
    twice = by_state.unionByName(by_state)
    stored = fit_stored("decision_tree_regressor", by_state, spark.read.parquet(f"{lake}/gbt_regressor/state_index"), f"{lake}/by_state")
    assert not certificates.node_table(stored).where("categories > 0").isEmpty()
    assert set(holds(certificates.leaf_rules(stored, "decision_tree_regressor", by_state, "magnitudo")).values()) == {True}
    assert not any(holds(certificates.leaf_rules(stored, "decision_tree_regressor", twice, "magnitudo")).values())
    told = stored.model.transform(by_state).select("event_id", "prediction").join(certificates.relational_predictions(stored, twice, "decision_tree_regressor"), "event_id")
    assert told.where("abs(prediction - recomputed) > 1e-9").isEmpty() and told.count() == 400


def test_a_step_down_a_tree_looks_up_where_the_row_stands(spark, features, lake):
    """Values on a threshold, beside all of them and unknown ones go where the library's own scoring sends them."""
    vectors, stored = fitted(features, "random_forest_regressor", lake, numTrees=5, maxDepth=4)
    trees = certificates._trees(stored, classes=False)
    edges = {i: parts for i, parts in trees.scales if not isinstance(parts, int)}
    assert len(edges) > 4 and all(len(e) < 128 and list(e) == sorted(set(e)) for e in edges.values())
    rng, rows = random.Random(3), []
    for _ in range(200):
        rows.append([rng.choice([*edges.get(i, [0.0]), -1e9, 1e9, float("nan"), -0.0, 7.5]) for i in range(7)] + [float(rng.randrange(4))])
    told = [stored.model.predict(Vectors.dense(x)) for x in rows]
    got = sum(trees.value[at] for at in trees.walker()(np.array(rows))) / 5
    assert list(got) == pytest.approx(told, abs=1e-12)

    by_state = vectors.withColumn("magnitudo", F.when(F.col(STATE_INDEX).isin(0.0, 2.0), 1.0).otherwise(5.0) + F.col("depth") / 1e6)
    stored = fit_stored("decision_tree_regressor", by_state, spark.read.parquet(f"{lake}/random_forest_regressor/state_index"), f"{lake}/by_state")
    trees = certificates._trees(stored, classes=False)
    assert trees.listed and any(isinstance(parts, int) for _, parts in trees.scales)
    rows = [[0.0] * 7 + [c] for c in (0.0, 1.0, 2.0, 3.0, 1.5, -1.0, 99.0)]
    (at,) = trees.walker()(np.array(rows))
    assert list(trees.value[at][:4]) == pytest.approx([stored.model.predict(Vectors.dense(x)) for x in rows[:4]])
    assert len(set(at[4:])) == 1 and trees.value[at][4] in trees.value[at][:4]  # no category: right, at each split


def test_a_tree_of_one_leaf_is_walked_too(features, lake):
    vectors, stored = fitted(features.withColumn("magnitudo", F.lit(4.0)), "decision_tree_regressor", lake)
    trees = certificates._trees(stored, classes=False)
    assert len(trees.node) == 1 and [list(trees.value[at]) for at in trees.walker()(np.zeros((3, 8)))] == [[4.0] * 3]


@pytest.mark.parametrize("name", ["random_forest_regressor", "random_forest_classifier"])
def test_forests_keep_where_rows_are_and_grow_the_same_trees(spark, features, lake, name):
    """Without it, each level leads every row down every tree from the root."""
    assert estimator(name).getCacheNodeIds() and "cacheNodeIds" not in hyperparameters(name)
    assert not estimator("decision_tree_regressor").getCacheNodeIds()
    risk = data.classification_data(features)
    frame = data.regression_data(features) if name in REGRESSORS else data.with_class_weights(risk, {0.0: 0.7, 1.0: 1.5})
    index = state_index(frame)
    vectors = written(with_vector(frame, index, input_columns(name)[:-1], states=index.count()), "vectors")
    nodes = [certificates.node_table(fit_stored(name, vectors, index, f"{lake}/{kept}", numTrees=6, cacheNodeIds=kept)).orderBy("tree", "id").collect() for kept in (True, False)]
    assert nodes[0] == nodes[1] and len(nodes[0]) > 12


def test_every_core_scores(spark, features, lake):
    train(REGRESSION, data.regression_data(features), lake, models=["decision_tree_regressor"])
    scored = inference.predict(REGRESSION, features.coalesce(1), runs.read_runs(spark, f"{lake}/runs"))
    assert scored.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and scored.count() == 400
    assert {r[0] for r in scored.select("event_id").collect()} == {f"e{i}" for i in range(400)}


def test_vectors_of_a_few_splits_for_each_core_are_dealt_too(spark, features):
    """Two splits for each core and one more would take as long as three."""
    cores = spark.sparkContext.defaultParallelism
    assert spread(features.coalesce(1), cores * 2_000_000).rdd.getNumPartitions() == cores


def test_moments_are_one_aggregate(spark, features, lake):
    vectors, stored = fitted(features, "linear_regression_baseline", lake)
    assert "Generate" not in plan(certificates.optimality(stored, "linear_regression_baseline", vectors, label="magnitudo")).split("Aggregate")[-1]


def test_every_core_gets_vectors(spark, features):
    one = features.coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert spread(one, 400).rdd.getNumPartitions() == cores and spread(one, 400, rows_per_core=1).rdd.getNumPartitions() == 1


def run(i, **changes):
    base = {
        "run_id": f"r{i}", "experiment": "x", "status": "FINISHED", "start_time": datetime(2024, 1, 1, 0, i), "end_time": None,
        "artifact_uri": f"m/{i}", "params": {"model_name": f"m{i}"}, "metrics": {"rmse": 1.0 + i}, "tags": {"team": "t", "mlflow.user": "u"},
    }
    return base | changes


def test_run_table(spark, lake):
    path = f"{lake}/runs"
    runs.append_run(spark, path, run(0, metrics={"rmse": float("nan"), "f1": 0.5}))
    runs.append_run(spark, path, run(1, params={"model_name": "m1", "depth": 8}))
    runs.append_run(spark, path, run(2, metrics={"rmse": 2.0, "mae": 1.0, "r2": 0.5}))
    runs.append_run(spark, path, run(3, experiment="y", metrics={}))
    log = runs.read_runs(spark, path)
    assert [r["run_id"] for r in runs.best_runs(log, "x", "rmse", ascending=True, limit=9).collect()] == ["r2", "r1", "r0"]
    assert runs.best_run(log, "x", "f1", ascending=False)["run_id"] == "r0"
    assert runs.best_run(log, "none", "f1", ascending=False) is None
    assert runs.metric_comparison(log, "x").collect() == [(2.0, 1.0, 0.5, "m2")]
    summary = runs.run_summary(log)
    assert summary.columns[6:] == ["metric_f1", "metric_mae", "metric_r2", "metric_rmse", "param_depth", "param_model_name", "tag_team"]
    assert summary.count() == 4
    assert sorted(r["run_id"] for r in runs.newest_runs(log, 1).collect()) == ["r2", "r3"]

    runs.write_csv(summary, f"{lake}/csv")
    (file,) = glob(f"{lake}/csv/*.csv")
    with open(file, newline="") as handle:
        rows = list(csv.DictReader(handle))
    assert list(rows[0]) == sorted(summary.columns) and len(rows) == 4
    runs.write_csv(summary.where("run_id = 'none'"), f"{lake}/none")
    assert [open(f).read().strip() for f in glob(f"{lake}/none/*.csv")] == ["empty"]

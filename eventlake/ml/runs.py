"""The run table: one row per training with parameter, metric and tag maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.sources.tables import table_exists

# Summary size and the prefix of tags that belong to the tracking system.
NEWEST_RUNS = 100
SYSTEM_TAG_PREFIX = "mlflow."

RUN_SCHEMA = (
    "run_id string, experiment string, status string, start_time timestamp, end_time timestamp, artifact_uri string, "
    "params map<string,string>, metrics map<string,double>, tags map<string,string>"
)
_PREFIXES = {"params": "param", "metrics": "metric", "tags": "tag"}


def append_run(spark: SparkSession, path: str, run: dict) -> None:
    """Log one run. A metric that is NaN is left out."""
    metrics = {k: float(v) for k, v in run["metrics"].items() if v is not None and v == v}
    params = {k: str(v) for k, v in run["params"].items()}
    row = [{**run, "params": params, "metrics": metrics}]
    spark.createDataFrame(row, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run table; without rows while nothing was trained."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], RUN_SCHEMA)
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def _metric(name: str) -> Column:
    value = F.col("metrics")[name]
    return F.when(~F.isnan(value), value)


def best_runs(runs: DataFrame, experiment: str, metric: str, *, ascending: bool, limit: int = 1) -> DataFrame:
    """Runs of an experiment from the best; without the metric last, ties by newest, then run id."""
    value = _metric(metric)
    order = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    return runs.where(F.col("experiment") == experiment).orderBy(order, F.desc("start_time"), "run_id").limit(limit)


def best_run(runs: DataFrame, experiment: str, metric: str, *, ascending: bool) -> Row | None:
    return best_runs(runs, experiment, metric, ascending=ascending).first()


def newest_runs(runs: DataFrame, limit: int = NEWEST_RUNS) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("experiment").orderBy(F.desc("start_time"), "run_id"))
    return runs.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def _keys_of(map_column: str) -> Column:
    return F.transform(F.map_keys(map_column), lambda key: F.struct(F.lit(map_column).alias("map"), key.alias("key")))


def run_summary(runs: DataFrame, limit: int = NEWEST_RUNS) -> DataFrame:
    """The newest runs per experiment with one ``param_``, ``metric_`` or ``tag_`` column per map key.

    Map keys are collected from the runs shown, a bounded number, to name the columns.
    """
    shown = newest_runs(runs, limit)
    entries = [_keys_of(m) for m in _PREFIXES]
    keys = sorted((r["map"], r["key"]) for r in shown.select(F.inline(F.concat(*entries))).distinct().collect())
    keys = [(m, k) for m, k in keys if not (m == "tags" and k.startswith(SYSTEM_TAG_PREFIX))]
    flat = {f"{_PREFIXES[m]}_{k}": F.col(m)[k] for m, k in keys}
    info = {"experiment_name": F.col("experiment")} | {
        c: F.col(c) for c in ("run_id", "status", "start_time", "end_time", "artifact_uri")
    }
    return shown.select(*(e.alias(c) for c, e in {**info, **flat}.items()))


def metric_comparison(runs: DataFrame, experiment: str) -> DataFrame:
    """Error metrics per model, newest run first; runs that lack one are left out."""
    columns = {
        "RMSE": _metric("rmse"),
        "MAE": _metric("mae"),
        "R2": _metric("r2"),
        "Model": F.col("params")["model_name"],
    }
    chosen = runs.where(F.col("experiment") == experiment).orderBy(F.desc("start_time"), "run_id")
    return chosen.select(*(e.alias(c) for c, e in columns.items())).dropna()


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with its columns in alphabetical order; without rows only the header ``empty``."""
    rows = df.select(*sorted(df.columns))
    if rows.isEmpty():
        rows = rows.sparkSession.createDataFrame([], "empty string")
    rows.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)

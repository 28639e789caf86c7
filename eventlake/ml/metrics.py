"""Model quality from predictions, each family in one pass over them."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.ranking import totals_before


def regression_metrics(predictions: DataFrame, label: str = "magnitudo", prediction: str = "prediction") -> DataFrame:
    """One row with ``rmse``, ``mae`` and ``r2``. R-squared is NULL when all labels are equal."""
    error = F.col(label) - F.col(prediction)
    sums = predictions.agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(label).alias("var"))
    return sums.select(F.sqrt("mse").alias("rmse"), "mae", (F.lit(1.0) - F.try_divide("mse", "var")).alias("r2"))


def confusion_matrix(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predictions.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count")).orderBy(label, prediction)


def classification_metrics(confusion: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row with accuracy and the class-weighted precision, recall and F1 of a confusion matrix.

    Every cell counts once for its true class and once for its predicted class.
    """
    hit = F.when(F.col(label) == F.col(prediction), F.col("count")).otherwise(0)
    nothing = F.lit(0).cast("bigint")

    def side(of_class: str, actual: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(of_class).cast("double").alias("cls"), actual.alias("actual"), predicted.alias("predicted"), hits.alias("hits")
        )

    sides = F.array(side(label, F.col("count"), nothing, hit), side(prediction, nothing, F.col("count"), nothing))
    per_class = confusion.select(F.inline(sides)).groupBy("cls").agg(*(F.sum(c).alias(c) for c in ("actual", "predicted", "hits")))

    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    scored = per_class.select("actual", "hits", precision.alias("p"), recall.alias("r")).withColumn("f", f1)

    def weighted(column: str) -> Column:
        return F.sum(F.col("actual") * F.col(column)) / F.sum("actual")

    return scored.agg(
        (F.sum("hits") / F.sum("actual")).alias("accuracy"),
        weighted("p").alias("precision"),
        weighted("r").alias("recall"),
        weighted("f").alias("f1"),
    )


def roc_auc(predictions: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs in right order.

    Equal scores count half. Scores are counted first, then ranked across the whole table. NULL when
    a class is absent.
    """
    is_positive = F.col(label) == 1
    per_score = predictions.groupBy(score).agg(F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg"))
    ranked = totals_before(per_score, [score], ["neg"])
    # As doubles: the number of pairs outgrows a long.
    ordered = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.sum(F.col("pos").cast("double")) * F.sum(F.col("neg").cast("double"))
    return ranked.agg(F.try_divide(ordered, pairs).alias("roc_auc"))


def curve_auc(predictions: DataFrame, label: str = "label") -> float:
    """Area under the thinned curve of Spark's evaluator on ``rawPrediction``, NaN if it has none."""
    if "rawPrediction" not in predictions.columns:
        return float("nan")
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    return float(evaluator.evaluate(predictions))

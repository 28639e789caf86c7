"""Clean layer to analytic tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions import step_label
from eventlake.operators.lookup import join_unique
from eventlake.operators.ranking import frequency_index
from eventlake.operators.silver import UNKNOWN_STATE
from eventlake.schemas import FEATURE_COLUMNS, RISK_COLUMNS, conform

# Bucket names with their exclusive upper bounds, and flag thresholds.
DEPTH_STEPS = (("negative", 0), ("shallow", 70), ("medium", 300))
DEEPEST = "deep"
MAGNITUDE_STEPS = (("minor", 3), ("light", 5), ("moderate", 6), ("strong", 7))
STRONGEST = "major"
SHALLOW_BELOW = 70
DEEP_FROM = 300
HIGH_SIGNIFICANCE_FROM = 500


def usable(clean_df: DataFrame) -> DataFrame:
    """Valid records with a timestamp and a magnitude; all three conditions reach the scan."""
    return clean_df.where("is_valid_record AND event_timestamp IS NOT NULL AND magnitudo IS NOT NULL").withColumn(
        "state", F.coalesce("state", F.lit(UNKNOWN_STATE))
    )


def with_feature_columns(df: DataFrame) -> DataFrame:
    depth, magnitude = F.col("depth"), F.col("magnitudo")
    return df.withColumns(
        {
            "abs_latitude": F.abs("latitude"),
            "abs_longitude": F.abs("longitude"),
            "depth_bucket": step_label(depth, DEPTH_STEPS, DEEPEST),
            "magnitude_bucket": step_label(magnitude, MAGNITUDE_STEPS, STRONGEST),
            "is_shallow": (depth >= 0) & (depth < SHALLOW_BELOW),
            "is_medium_depth": (depth >= SHALLOW_BELOW) & (depth < DEEP_FROM),
            "is_deep": depth >= DEEP_FROM,
            "is_high_significance": F.col("significance") >= HIGH_SIGNIFICANCE_FROM,
            "is_tsunami": F.col("tsunami") == 1,
        }
    )


def feature_table(clean_df: DataFrame) -> DataFrame:
    """The feature table. ``state_index`` ranks states by frequency over the rows of this table.

    The first pass counts rows per state (two narrow columns plus the filter), the second projects.
    """
    base = usable(clean_df)
    index = frequency_index(base, "state", "state_index")
    indexed = join_unique(
        with_feature_columns(base), index, "state", keyed_rows=index.count(), spread_by="record_natural_key"
    )
    return conform(indexed, FEATURE_COLUMNS, "feature table")


def _measures(*names: str) -> list[Column]:
    """Aggregates of the feature table by output name. Conditional counts skip NULL."""
    known = {
        "event_count": F.count(F.lit(1)),
        "tsunami_count": F.count_if(F.col("tsunami") == 1),
        "high_significance_count": F.count_if("is_high_significance"),
        "first_event_time": F.min("event_timestamp"),
        "last_event_time": F.max("event_timestamp"),
    }
    for prefix, function in {"avg": F.avg, "min": F.min, "max": F.max}.items():
        known |= {f"{prefix}_magnitude": function("magnitudo"), f"{prefix}_depth": function("depth")}
    return [known[name].alias(name) for name in names]


def daily_aggregates(features: DataFrame) -> DataFrame:
    measures = _measures(
        "event_count", "avg_magnitude", "max_magnitude", "min_magnitude", "avg_depth", "max_depth",
        "tsunami_count", "high_significance_count",
    )
    return features.groupBy(F.to_date("event_timestamp").alias("date_day")).agg(*measures)


def state_aggregates(features: DataFrame) -> DataFrame:
    """One row per state. Sort with :func:`by_event_count` when reading: a table keeps no order."""
    measures = _measures(
        "event_count", "avg_magnitude", "max_magnitude", "avg_depth", "tsunami_count", "first_event_time", "last_event_time"
    )
    return features.groupBy("state").agg(*measures)


def by_event_count(states: DataFrame) -> DataFrame:
    return states.orderBy(F.desc("event_count"), "state")


def by_day(days: DataFrame) -> DataFrame:
    return days.orderBy("date_day")


def tsunami_risk_set(features: DataFrame) -> DataFrame:
    """Columns for the tsunami classifier where all of them are known. NaN counts as known here."""
    needed = [c for c in RISK_COLUMNS if c not in ("event_id", "state", "state_index")]
    known = " AND ".join(f"{c} IS NOT NULL" for c in needed)
    return conform(features, RISK_COLUMNS, "risk set").where(known)


def class_distribution(df: DataFrame, column: str = "tsunami") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(column)

"""Data-quality report on the clean or the raw layer.

The report needs three passes whatever the number of columns: one aggregate for all counters, one
for all value distributions and the years, one for the top records. A metric whose column is absent is NULL, a list empty.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions import inside, to_double
from eventlake.operators.silver import LATITUDE_RANGE, LONGITUDE_RANGE

# Report sizes.
DISTRIBUTION_LIMITS = {"tsunami": 10, "status": 30, "data_type": 30}
DEFAULT_LIMIT = 50
TOP_STATES = 20
TOP_RECORDS = 20
TOP_RECORD_COLUMNS = ["event_id", "event_timestamp", "place", "state", "magnitudo", "depth"]


def _number(df: DataFrame, column: str) -> Column:
    """The column as double; raw-layer text goes through the NULL-on-error cast."""
    return to_double(F.col(column)) if df.schema[column].dataType.typeName() == "string" else F.col(column)


def _counters(df: DataFrame) -> dict[str, Column]:
    """Conditions to count, by metric name, for the columns the frame has."""
    rules = {
        "invalid_latitude_count": ("latitude", lambda x: ~inside(x, *LATITUDE_RANGE)),
        "invalid_longitude_count": ("longitude", lambda x: ~inside(x, *LONGITUDE_RANGE)),
        "null_magnitudo_count": ("magnitudo", lambda x: x.isNull()),
        "negative_depth_count": ("depth", lambda x: x < 0),
    }
    return {name: rule(_number(df, c)) for name, (c, rule) in rules.items() if c in df.columns}


def _long(row: DataFrame, entries: list[tuple[str, str | None, str]]) -> DataFrame:
    """Turn a one-row frame into ``metric, key, value`` rows; entries are (metric, key, source column)."""
    structs = [
        F.struct(F.lit(m).alias("metric"), F.lit(k).cast("string").alias("key"), F.col(c).alias("value"))
        for m, k, c in entries
    ]
    return row.select(F.inline(F.array(*structs)))


def counters(df: DataFrame) -> DataFrame:
    """Total, NULL count of every column, and rule counts: ``metric, key, value`` from one aggregate."""
    rules = _counters(df)
    aggregates = [F.count(F.lit(1)).alias("total")]
    aggregates += [F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)]
    aggregates += [F.count_if(rule).alias(f"rule_{name}") for name, rule in rules.items()]
    entries = [("total_record_count", None, "total")]
    entries += [("null_counts", c, f"null_{i}") for i, c in enumerate(df.columns)]
    entries += [(name, None, f"rule_{name}") for name in rules]
    return _long(df.agg(*aggregates), entries)


def null_counts(df: DataFrame) -> DataFrame:
    return counters(df).where("metric = 'null_counts'").select(F.col("key").alias("column"), F.col("value").alias("null_count"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row counts per value of each column: ``column, value, count`` with values as text.

    One pass: each row is expanded to its values and counted map-side. Absent columns are skipped.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, value string, count bigint")
    texts = df.select(*(F.col(c).cast("string").alias(c) for c in present))
    # grouping(c) is 0 in the grouping set of column c.
    grouped = texts.groupingSets([[c] for c in present], *present).agg(
        F.count(F.lit(1)).alias("count"), *(F.grouping(c).alias(f"_{c}") for c in present)
    )
    pick = [F.when(F.col(f"_{c}") == 0, F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))) for c in present]
    return grouped.select(F.coalesce(*pick).alias("entry"), "count").select("entry.*", "count")


def top_values(df: DataFrame, limits: Mapping[str, int], whole: Sequence[str] = ()) -> DataFrame:
    """The most frequent values per column, ties by value (NULL first): adds ``rank`` from 1.

    Of the columns ``whole`` every value stays, each with rank 1, from the same pass.
    """
    alone = F.when(F.col("column").isin(list(whole)), F.col("value")) if whole else F.lit(None).cast("string")
    by_count = Window.partitionBy("column", alone).orderBy(F.desc("count"), F.asc_nulls_first("value"))
    ranked = value_counts(df, [*limits, *whole]).withColumn("rank", F.row_number().over(by_count))
    widest = max([1, *limits.values()])
    allowed = F.coalesce(*(F.when(F.col("column") == c, n) for c, n in limits.items()), F.lit(1))
    # The constant bound lets Spark limit each group before the shuffle; the second is the exact limit.
    return ranked.where(F.col("rank") <= widest).where(F.col("rank") <= allowed)


def value_distribution(df: DataFrame, column: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Most frequent values of one column in its own type, ties by value. Empty if it is absent."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], f"`{column}` string, count bigint")
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), F.asc_nulls_first(column)).limit(limit)


def yearly_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("count")).orderBy("year")


def top_magnitude(df: DataFrame, limit: int = TOP_RECORDS) -> DataFrame:
    """The strongest events, ties by event id."""
    strongest = [F.desc_nulls_last("magnitudo"), F.asc("event_id")]
    return df.select(*TOP_RECORD_COLUMNS).orderBy(*strongest).limit(limit)


def report(df: DataFrame, generated_at: str | None = None) -> DataFrame:
    """All metrics as ``metric, key, value`` text rows.

    List-valued metrics carry their position in ``key`` (zero-padded, so text order is list order)
    and a JSON object in ``value``.
    """
    parts = []
    if generated_at is not None:
        stamp = df.sparkSession.range(1).select(
            F.lit("generated_at").alias("metric"), F.lit(None).cast("string").alias("key"), F.lit(generated_at).alias("value")
        )
        parts.append(stamp)
    parts.append(counters(df).withColumn("value", F.col("value").cast("string")))

    names = {c: f"{c}_distribution" for c in DISTRIBUTION_LIMITS} | {"state": "top_states_by_event_count", "year": "yearly_record_count"}
    limits = {c: n for c, n in {**DISTRIBUTION_LIMITS, "state": TOP_STATES}.items() if c in df.columns}
    years = ["year"] if "year" in df.columns else []
    counted = [*limits, *years]
    if counted:
        tops = top_values(df, limits, years)
        metric = F.coalesce(*(F.when(F.col("column") == c, F.lit(names[c])) for c in counted))
        objects = [
            F.when(F.col("column") == c, _object(F.col("value").cast(df.schema[c].dataType).alias(c), "count")) for c in counted
        ]
        of_year = F.coalesce(F.lpad("value", 6, "0"), F.lit(""))
        key = F.when(F.col("column") == "year", of_year).otherwise(_position("rank"))
        parts.append(tops.select(metric.alias("metric"), key.alias("key"), F.coalesce(*objects).alias("value")))
    if set(TOP_RECORD_COLUMNS) <= set(df.columns):
        order = Window.orderBy(F.desc_nulls_last("magnitudo"), F.asc("event_id"))
        # At most TOP_RECORDS rows are left here.
        tops = top_magnitude(df).withColumn("rank", F.row_number().over(order))
        parts.append(tops.select(F.lit("top_magnitudo_records").alias("metric"), _position("rank"), _object(*TOP_RECORD_COLUMNS)))

    told = {"total_record_count", "null_counts", *_counters(df), *(names[c] for c in counted)}
    told |= {"top_magnitudo_records"} if set(TOP_RECORD_COLUMNS) <= set(df.columns) else set()
    untold = [(m, None, None) for m in METRICS if m not in told and m != "generated_at"]
    if untold:
        parts.append(df.sparkSession.createDataFrame(untold, "metric string, key string, value string"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _position(rank: str) -> Column:
    return F.lpad(F.col(rank).cast("string"), 6, "0").alias("key")


def _object(*columns: str | Column) -> Column:
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.to_json(F.struct(*columns), options).alias("value")


# The metrics in the order of the report document.
METRICS = (
    "generated_at",
    "total_record_count",
    "null_counts",
    "invalid_latitude_count",
    "invalid_longitude_count",
    "null_magnitudo_count",
    "negative_depth_count",
    "tsunami_distribution",
    "status_distribution",
    "data_type_distribution",
    "yearly_record_count",
    "top_magnitudo_records",
    "top_states_by_event_count",
)
LIST_METRICS = (*(f"{c}_distribution" for c in DISTRIBUTION_LIMITS), "top_states_by_event_count", "yearly_record_count", "top_magnitudo_records")


def by_metric(report_df: DataFrame) -> DataFrame:
    """One ``metric, value`` row per metric; keyed metrics become a JSON object or list in key order.

    A metric's name decides its form, never its keys: records without a timestamp make a year without a value.

    The report is bounded: its size depends on the number of columns, the limits and the years.
    """
    entries = F.sort_array(F.collect_list(F.struct("key", "value")))
    grouped = report_df.groupBy("metric").agg(entries.alias("entries"))
    values = F.transform("entries", lambda e: e["value"])
    as_list = F.concat(F.lit("["), F.array_join(values, ","), F.lit("]"))
    as_object = F.to_json(F.map_from_entries(F.transform("entries", lambda e: F.struct(e["key"], e["value"].cast("bigint")))))
    text = (
        F.when(F.col("metric") == "null_counts", as_object)
        .when(F.col("metric").isin(*LIST_METRICS), as_list)
        .otherwise(F.col("entries")[0]["value"])
    )
    return grouped.select("metric", text.alias("value"))


def document(metrics: DataFrame) -> DataFrame:
    """The report as one JSON object, column ``document``: numbers, objects and lists by metric, a missing value as null.

    ``metrics``: what :func:`by_metric` gives, one row for each of a dozen metrics.
    """
    place = F.coalesce(F.array_position(F.array(*map(F.lit, METRICS)), F.col("metric")), F.lit(0))
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    value = F.when(F.col("metric") == "generated_at", quoted(F.col("value"))).otherwise(F.col("value"))
    member = F.concat(quoted(F.col("metric")), F.lit(":"), F.coalesce(value, F.lit("null")))
    members = F.transform(F.sort_array(F.collect_list(F.struct(place.alias("place"), member.alias("member")))), lambda e: e["member"])
    return metrics.agg(F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")).alias("document"))


def write_report(report_df: DataFrame, folder: str) -> None:
    """Write the report as one JSON object and as a two-column CSV with header, one file each."""
    rows = by_metric(report_df).coalesce(1).persist()
    try:
        document(rows).coalesce(1).write.mode("overwrite").text(f"{folder}/data_quality_report_json")
        rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/data_quality_report_csv")
    finally:
        rows.unpersist()

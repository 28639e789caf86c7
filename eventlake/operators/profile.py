"""Column profiles: the numbers behind the usual exploratory charts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.operators.quality import counters, value_counts

# Profiled columns and chart sizes.
PROFILE_COLUMNS = ["magnitudo", "depth", "latitude", "longitude", "significance"]
HISTOGRAM_COLUMNS = ["magnitudo", "depth", "significance"]
SHARE_COLUMNS = ["depth_bucket", "magnitude_bucket", "tsunami"]
BINS = 30
TOP_STATES = 15
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
#: Parts that a bracket of values is counted by in one pass of a selection.
SELECTION_BINS = 4096


def _known(column: str) -> Column:
    """The column as double with NaN as NULL: both count as missing in a profile."""
    number = F.col(column).cast("double")
    return F.when(~F.isnan(number), number)


class _Bracket(NamedTuple):
    """Values of a column from ``low`` to ``high``, both of which occur, with ``before`` of its values below them."""

    column: str
    low: float
    high: float
    before: int


def _bin(bracket: _Bracket, first: bool) -> Column:
    """The part of its bracket that a value falls into, NULL outside. Parts are in the order of the values, and the two ends lie
    in different ones.

    Equal widths, but where these could go on for long: infinite ends are parts of their own, a bracket around zero is split there
    once equal widths have been tried, and one that spans many magnitudes is split by magnitude.
    """
    value, (_, low, high, _) = _known(bracket.column), bracket

    def width_of(x: Column, start: float, end: float) -> Column:
        return F.floor((x - F.lit(start)) / F.lit(end - start) * SELECTION_BINS)

    if math.isinf(low) or math.isinf(high):
        number = F.when(value == -math.inf, 0).when(value == math.inf, 2).otherwise(1)
    elif math.isinf(high - low) or (low < 0 < high and not first):
        number = F.signum(value)
    elif low * high > 0 and max(low / high, high / low) > SELECTION_BINS:
        ends = sorted([abs(low), abs(high)])
        number = math.copysign(1, low) * width_of(F.log(F.abs(value)), *map(math.log, ends))
    else:
        number = F.least(width_of(value, low, high), F.lit(SELECTION_BINS - 1))
    return F.when(value.between(low, high), number.cast("int"))


def _values_at(df: DataFrame, ranks: dict[str, set[int]], whole: dict[str, _Bracket]) -> dict[tuple[str, int], float]:
    """The values of each column at the given ranks (from 0), by selection.

    Each pass counts the values of every open bracket by parts and goes on with the part that holds the rank, until its smallest
    and largest value are one. A pass shuffles counts of parts, never values; one row for each rank comes to the driver and
    enters the next pass as constants. Eight passes suffice for any doubles, two for a few thousand distinct ones.
    """
    found = {(c, r): whole[c] for c, wanted in ranks.items() for r in wanted}
    first = True
    while True:
        brackets = sorted({b for b in found.values() if b.low < b.high})
        if not brackets:
            return {target: b.low + 0.0 for target, b in found.items()}  # no negative zero
        parts = [F.struct(F.lit(i).alias("bracket"), _bin(b, first).alias("part"), _known(b.column).alias("value")) for i, b in enumerate(brackets)]
        measures = [F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")]
        counted = df.select(F.inline(F.array(*parts))).where("part IS NOT NULL").groupBy("bracket", "part").agg(*measures)
        below = Window.partitionBy("bracket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        placed = counted.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0)))
        wanted = [(t, brackets.index(b), t[1] - b.before) for t, b in found.items() if b.low < b.high]
        holds = [(F.col("bracket") == i) & (F.col("before") <= r) & (F.col("before") + F.col("n") > r) for _, i, r in wanted]
        rows = placed.where(reduce(Column.__or__, holds)).collect()
        for target, i, r in wanted:
            (row,) = [x for x in rows if x["bracket"] == i and x["before"] <= r < x["before"] + x["n"]]
            found[target] = _Bracket(target[0], row["low"], row["high"], brackets[i].before + row["before"])
        first = False


def exact_quantiles(df: DataFrame, columns: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    """Quantiles per column with linear interpolation between neighbours: ``column`` and one column each.

    A column without values has no row. Nothing is ranked or written: see :func:`_values_at`.
    """
    measures = {"n": F.count, "low": F.min, "high": F.max}
    row = df.agg(*(f(_known(c)).alias(f"{m}_{i}") for i, c in enumerate(columns) for m, f in measures.items())).first()
    whole = {c: _Bracket(c, row[f"low_{i}"], row[f"high_{i}"], 0) for i, c in enumerate(columns) if row[f"n_{i}"]}
    places = {c: [q * (row[f"n_{i}"] - 1) for q in quantiles.values()] for i, c in enumerate(columns) if c in whole}
    values = _values_at(df, {c: {f(p) for p in at for f in (math.floor, math.ceil)} for c, at in places.items()}, whole)

    def between(c: str, place: float) -> float:
        low, high = values[c, math.floor(place)], values[c, math.ceil(place)]
        return low if low == high else low + (high - low) * (place - math.floor(place))

    rows = [(c, *(between(c, p) for p in at)) for c, at in places.items()]
    return df.sparkSession.createDataFrame(rows, ", ".join(["column string", *(f"{name} double" for name in quantiles)]))


def numeric_profile(
    df: DataFrame,
    columns: Sequence[str] = PROFILE_COLUMNS,
    digits: int = 2,
    *,
    accuracy: int | None = None,
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column, rounded.

    A column without any value has count 0 and NULL elsewhere. With an ``accuracy`` the quartiles are
    approximate (rank error 1 / accuracy) and come from the same single pass as the rest.
    """
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if accuracy is not None:
        measures |= {n: lambda x, q=q: F.percentile_approx(x, q, accuracy) for n, q in QUARTILES.items()}
    flat = df.agg(*(f(_known(c)).alias(f"{m}_{i}") for i, c in enumerate(columns) for m, f in measures.items()))
    per_column = [
        F.struct(F.lit(c).alias("column"), *(F.col(f"{m}_{i}").alias(m) for m in measures)) for i, c in enumerate(columns)
    ]
    moments = flat.select(F.inline(F.array(*per_column)))
    joined = moments
    if accuracy is None:
        joined = moments.join(F.broadcast(exact_quantiles(df, columns, QUARTILES)), "column", "left")  # one row per column
    rounded = [F.round(c, digits).alias(c) for c in ["mean", "std", "min", *QUARTILES, "max"]]
    return joined.select("column", "count", *rounded)


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count and percentage of the columns that miss anything, with the grand total on each row.

    NaN is missing too, as in :func:`numeric_profile`.
    """
    doubles = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    unified = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})
    counts = counters(unified).where("metric IN ('null_counts', 'total_record_count')")
    # One row per column of the frame, so the window runs over a handful of rows.
    total = F.max(F.when(F.col("metric") == "total_record_count", F.col("value")))
    per_column = F.filter(F.collect_list(F.struct("key", "value")), lambda e: e["key"].isNotNull())
    nested = counts.agg(total.alias("total"), per_column.alias("entries"))
    grand = F.aggregate("entries", F.lit(0).cast("bigint"), lambda acc, e: acc + e["value"])
    rows = nested.select("total", grand.alias("total_missing"), F.inline("entries"))
    share = F.round(F.col("value") / F.col("total") * 100, 2)
    return rows.where("value > 0").select(
        F.col("key").alias("column"), F.col("value").alias("missing_count"), share.alias("missing_pct"), "total_missing"
    )


def histogram(df: DataFrame, columns: Sequence[str] = HISTOGRAM_COLUMNS, bins: int = BINS) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty bins included: ``column, bin, low, high, count``.

    The last bin holds the maximum. A column with one distinct value gets a range of 1 around it.
    Two passes: the ranges, one row, come to the driver and enter the second pass as constants.
    """
    ranges = df.agg(*(f(_known(c)).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max)))).first()
    limits = {}
    for i, c in enumerate(columns):
        low, high = ranges[f"lo_{i}"], ranges[f"hi_{i}"]
        if low == -math.inf or high == math.inf:
            raise ValueError(f"{c}: no equal-width bins over infinite values")
        if low is not None:
            limits[c] = (low - 0.5, high + 0.5) if low == high else (low, high)
    if not limits:
        return df.sparkSession.createDataFrame([], "column string, bin int, low double, high double, count bigint")

    def bin_of(c: str) -> Column:
        low, high = limits[c]
        number = F.floor((_known(c) - F.lit(low)) / F.lit(high - low) * bins)
        return F.when(number < bins, number).when(number >= bins, bins - 1).cast("int")

    pairs = [F.struct(F.lit(c).alias("column"), bin_of(c).alias("bin")) for c in limits]
    counted = df.select(F.inline(F.array(*pairs))).where("bin IS NOT NULL").groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"))
    frame = df.sparkSession.createDataFrame([(c, lo, hi) for c, (lo, hi) in limits.items()], "column string, lo double, hi double")
    grid = frame.select("column", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counted, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("lo") + width * F.col("bin")).alias("low"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def category_shares(df: DataFrame, columns: Sequence[str] = SHARE_COLUMNS) -> DataFrame:
    """Count and percentage (one digit) of every value per column, missing values left out."""
    counted = value_counts(df, list(columns)).where("value IS NOT NULL")
    totals = counted.groupBy("column").agg(F.sum("count").alias("total"))
    share = F.round(F.col("count") / F.col("total") * 100, 1)
    return counted.join(F.broadcast(totals), "column").select("column", "value", "count", share.alias("pct"))


def hourly_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("hour").agg(F.count(F.lit(1)).alias("count")).orderBy("hour")


def largest_states(state_aggregates: DataFrame, limit: int = TOP_STATES) -> DataFrame:
    return state_aggregates.select("state", "event_count").orderBy(F.desc("event_count"), "state").limit(limit)


def location_points(df: DataFrame) -> DataFrame:
    return df.select("longitude", "latitude", "magnitudo")


def location_grid(df: DataFrame, degrees: float = 1.0) -> DataFrame:
    """Event count and mean magnitude per grid cell: what a map can show of any number of points."""
    cell = [F.floor(F.col(c) / degrees).alias(f"{c}_cell") for c in ("longitude", "latitude")]
    return df.groupBy(*cell).agg(F.count(F.lit(1)).alias("count"), F.avg("magnitudo").alias("avg_magnitude"))


def with_residual(predictions: DataFrame, actual: str = "magnitudo", predicted: str = "prediction") -> DataFrame:
    return predictions.withColumn("residual", F.col(actual) - F.col(predicted))


def ideal_line(predictions: DataFrame, actual: str = "magnitudo", predicted: str = "prediction") -> DataFrame:
    """Smallest and largest value over both columns, the ends of the actual = predicted line."""
    return predictions.agg(
        F.least(F.min(actual), F.min(predicted)).alias("min_value"),
        F.greatest(F.max(actual), F.max(predicted)).alias("max_value"),
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)

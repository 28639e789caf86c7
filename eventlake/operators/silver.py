"""Raw layer to clean layer: types, date parts, natural key, quality flags, score, validity."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions import inside, natural_key, to_double, to_instant, to_whole

# Coordinate ranges, points lost per flag, and the flags that make a record invalid.
LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)
FULL_SCORE = 100
PENALTIES = {
    "invalid_latitude": 25,
    "invalid_longitude": 25,
    "missing_magnitudo": 30,
    "missing_depth": 15,
    "negative_depth": 5,
}
DISQUALIFYING = ("invalid_latitude", "invalid_longitude", "missing_magnitudo", "missing_depth")
UNKNOWN_STATE = "unknown"


def _typed() -> dict:
    return {
        "time": to_whole(F.col("time"), "bigint"),
        "place": F.trim("place"),
        **{c: F.lower(F.trim(c)) for c in ("status", "data_type")},
        **{c: to_whole(F.col(c)) for c in ("tsunami", "significance")},
        **{c: to_double(F.col(c)) for c in ("magnitudo", "longitude", "latitude", "depth")},
        "state": F.coalesce(F.trim("state"), F.lit(UNKNOWN_STATE)),
        "date": to_instant(F.col("date"), to_whole(F.col("time"), "bigint")),
        "ingested_at": F.col("ingested_at").try_cast("timestamp"),
    }


def _derived() -> dict:
    date = F.col("date")
    return {
        "event_timestamp": date,
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "hour": F.hour(date),
        "record_natural_key": natural_key(F.col("time"), F.col("place"), date),
        "invalid_latitude": ~inside(F.col("latitude"), *LATITUDE_RANGE),
        "invalid_longitude": ~inside(F.col("longitude"), *LONGITUDE_RANGE),
        "missing_magnitudo": F.col("magnitudo").isNull(),
        "missing_depth": F.col("depth").isNull(),
        "negative_depth": F.col("depth") < 0,
    }


def _judged() -> dict:
    lost = [F.when(F.col(flag), F.lit(points)).otherwise(0) for flag, points in PENALTIES.items()]
    return {
        "quality_score": F.greatest(F.lit(FULL_SCORE) - sum(lost[1:], lost[0]), F.lit(0)),
        "is_valid_record": ~reduce(or_, map(F.col, DISQUALIFYING)),
    }


def clean(raw: DataFrame) -> DataFrame:
    """Type, normalise, flag and score raw records; no record is dropped.

    All expressions read the raw columns of one row, so Catalyst folds the three steps into one
    projection and the function works on streams. Empty text in ``state`` stays empty.
    """
    return raw.withColumns(_typed()).withColumns(_derived()).withColumns(_judged())


def valid_records(clean_df: DataFrame) -> DataFrame:
    return clean_df.where(F.col("is_valid_record"))


def quarantined_records(clean_df: DataFrame) -> DataFrame:
    return clean_df.where(~F.col("is_valid_record"))

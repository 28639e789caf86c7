"""Text-to-number and text-to-time casts that give NULL on bad text under any ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGRAL_PART = r"^\s*([+-]?\d+)\.?\d*\s*$"
_FRACTION_ONLY = r"^\s*[+-]?\.\d*\s*$"
_UTC_SUFFIX = r"\+00:00$"

# Range of whole seconds a microsecond timestamp can hold.
_LAST_SECOND = 9_223_372_036_854


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_whole(text: Column, width: str = "int") -> Column:
    """Integer cast with the lenient rule: ``'7.9'`` is 7, ``'.5'`` is 0, ``'1e3'`` is NULL.

    ``try_cast`` alone would turn ``'0.0'`` into NULL. It settles clean text without a regular
    expression; ``coalesce`` evaluates the others only when it fails.
    """
    return F.coalesce(
        text.try_cast(width),
        F.regexp_extract(text, _INTEGRAL_PART, 1).try_cast(width),
        F.when(text.rlike(_FRACTION_ONLY), F.lit(0).cast(width)),
    )


def to_instant(date: Column, epoch_ms: Column) -> Column:
    """Parse ``date``; failing that without its UTC suffix; failing that use the epoch milliseconds, a whole number.

    The epoch form keeps whole seconds only. An epoch beyond the timestamp range is NULL.
    """
    seconds = (epoch_ms / F.lit(1000)).cast("double")
    in_range = F.abs(seconds) <= F.lit(float(_LAST_SECOND))
    return F.coalesce(
        date.try_cast("timestamp"),
        F.regexp_replace(date, _UTC_SUFFIX, "").try_cast("timestamp"),
        F.timestamp_seconds(F.when(in_range, seconds).try_cast("bigint")),
    )

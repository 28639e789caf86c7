"""From CSV rows to identified events and to keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions import uuid5_url
from eventlake.schemas import EVENT_COLUMNS, RAW_COLUMNS

# The characters Unicode counts as white space, which Python's ``str.strip`` removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_IDENTITY_FIELDS = ("time", "place", "date")


def normalise(df: DataFrame) -> DataFrame:
    """Strip every raw column of surrounding white space and turn empty text into NULL."""
    stripped = {c: F.nullif(F.btrim(F.col(c), F.lit(WHITE_SPACE)), F.lit("")) for c in RAW_COLUMNS}
    return df.withColumns(stripped)


def event_identity(source_file: Column, row_number: Column) -> Column:
    """UUID of a row: file name, row number in the file, and three fields of a normalised row."""
    parts = [
        source_file,
        F.coalesce(row_number.cast("string"), F.lit("unknown-row")),
        *(F.coalesce(F.col(c), F.lit("")) for c in _IDENTITY_FIELDS),
    ]
    return uuid5_url(F.concat_ws("|", *parts))


def utc_now_text() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def build_events(
    rows: DataFrame,
    *,
    source_file: Column | None = None,
    row_number: Column | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Normalised rows plus ``event_id``, ``ingested_at`` and ``source_file``.

    ``rows`` is what :func:`eventlake.sources.csv_events.read_csv_rows` gives, or any frame with the
    raw columns when ``source_file`` and ``row_number`` are passed in. A NULL row number stands for
    an unknown row. ``ingested_at`` defaults to the time of the query.
    """
    source_file = F.col("source_file") if source_file is None else source_file
    row_number = F.col("row_number") if row_number is None else row_number
    metadata = {
        "event_id": event_identity(source_file, row_number),
        "ingested_at": utc_now_text() if ingested_at is None else ingested_at,
        "source_file": source_file,
    }
    return normalise(rows).withColumns(metadata).select(*EVENT_COLUMNS)


def message_key(key_field: str = "state") -> Column:
    """The key field when it holds text, otherwise the event id."""
    return F.coalesce(F.nullif(F.col(key_field), F.lit("")), F.col("event_id"))


def message_value() -> Column:
    """Compact JSON object of the event columns in order, absent values written as ``null``."""
    return F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"})


def to_messages(events: DataFrame, key_field: str = "state") -> DataFrame:
    return events.select(message_key(key_field).alias("key"), message_value().alias("value"))

"""Joins against a one-row-per-key side that stay balanced when a key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.session import BROADCAST_ROWS, TASK_ROWS, written

_SALT, _PARTS, _HOT = "_salt", "_parts", "_hot"


def hot_keys(facts: DataFrame, key: str, *, task_rows: int = TASK_ROWS, most: int = BROADCAST_ROWS) -> DataFrame:
    """Written: the keys (NULL too) with more than ``task_rows`` rows and the ``_parts`` that each is to be split into.

    Counts are combined before they are shuffled. There are at most rows / ``task_rows`` such keys; should that be more than
    ``most``, the rows asked for are doubled until they fit.
    """
    counted = facts.groupBy(F.col(key).alias(_HOT)).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > task_rows)
    hot = written(counted, "hot-keys")
    while hot.where(F.col("_n") > task_rows).limit(most + 1).count() > most:
        task_rows *= 2
    return hot.where(F.col("_n") > task_rows).select(_HOT, F.ceil(F.col("_n") / task_rows).cast("int").alias(_PARTS))


def join_unique(
    facts: DataFrame,
    keyed: DataFrame,
    key: str,
    *,
    spread_by: str,
    keyed_rows: int | None = None,
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    count_in: DataFrame | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Join ``facts`` with ``keyed``, which holds each key once and at most ``keyed_rows`` rows.

    Up to ``broadcast_rows`` the keyed side is broadcast and the facts are not shuffled. Beyond, or where the size is not known,
    both sides shuffle on the key, and every key with more than ``task_rows`` rows is split: its rows spread over as many parts
    as its frequency asks for, each with its own copy of the one matching row, so a part has about ``task_rows`` rows at
    most, whatever the key's share or rank. Rows without a key match nothing and are split alike. The part is a hash of
    ``spread_by``, so a task that is run again places its rows as before. ``count_in`` is a cheaper frame to count the keys in,
    one that holds all rows of the facts.
    """
    if keyed_rows is not None and keyed_rows <= broadcast_rows:
        return facts.join(F.broadcast(keyed), key, how)

    hot = F.broadcast(hot_keys(facts if count_in is None else count_in, key, task_rows=task_rows))
    parts = F.coalesce(F.col(_PARTS), F.lit(1))
    same = F.col(key).eqNullSafe(F.col(_HOT))
    salted = facts.join(hot, same, "left").withColumn(_SALT, F.pmod(F.xxhash64(spread_by), parts).cast("int")).drop(_HOT, _PARTS)
    copies = keyed.join(hot, same, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), parts - 1))).drop(_HOT, _PARTS)
    return salted.join(copies, [key, _SALT], how).drop(_SALT)

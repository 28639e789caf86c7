"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every row gets a 64-bit fingerprint of its text. The rows fall into blocks, pieces of the input's partitions.
2. A block sends its sorted distinct fingerprints, Golomb-coded, to the owners of their ranges.
3. An owner answers each block with one bit per fingerprint: another block has it too.
4. Only rows with a set bit, or with a fingerprint found twice in their block, are suspects. Their texts are grouped as
   whole byte strings, copies combined before the shuffle; equal fingerprints of different texts part here.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import text_of, written

#: Rows of a block, and fingerprints an owner is meant to hold. Both bound the memory of a task.
BLOCK_ROWS = 1 << 16
OWNER_ROWS = 1 << 19


def golomb_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Sorted distinct uint64 values as Golomb-Rice coded gaps: the remainder's width and the code."""
    gaps = np.diff(values, prepend=np.uint64(0))
    width = max(0, int(math.log2(max(1.0, float(values[-1]) / len(values) * math.log(2)))))
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    lengths = quotients + 1 + width
    ends = np.cumsum(lengths)
    starts = ends - lengths
    bits = np.zeros(int(ends[-1]), np.uint8)
    before = np.cumsum(quotients) - quotients
    bits[np.repeat(starts - before, quotients) + np.arange(int(quotients.sum()))] = 1
    for place in range(width):
        bits[starts + quotients + 1 + place] = (gaps >> np.uint64(width - 1 - place)) & np.uint64(1)
    return width, np.packbits(bits).tobytes()


def golomb_decode(count: int, width: int, code: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    zeros = np.where(bits == 0, np.arange(len(bits)), len(bits))
    next_zero = np.minimum.accumulate(zeros[::-1])[::-1].tolist()
    starts, stops, at = np.empty(count, np.int64), np.empty(count, np.int64), 0
    for i in range(count):
        starts[i] = at
        stops[i] = at = next_zero[at]
        at += 1 + width
    gaps = (stops - starts).astype(np.uint64)
    for place in range(width):
        gaps = (gaps << np.uint64(1)) | bits[stops + 1 + place].astype(np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _by_owner(fingerprints: np.ndarray, shift: int) -> list[tuple[int, np.ndarray]]:
    """Sorted fingerprints by owner, each as its distance from the start of the owner's range."""
    owners = fingerprints >> np.uint64(shift)
    rest = fingerprints & np.uint64((1 << shift) - 1)
    first = np.flatnonzero(np.diff(owners, prepend=owners[:1] + np.uint64(1)))
    return [(int(owners[a]), rest[a:b]) for a, b in zip(first, [*first[1:], len(rest)], strict=True)]


def _fingerprints(rows: pa.Table) -> np.ndarray:
    return np.ascontiguousarray(rows.column("fp").to_numpy()).view(np.uint64)


def suspects(prints: DataFrame, *, owner_rows: int = OWNER_ROWS) -> DataFrame:
    """The fingerprints (``fp``) that more than one row of ``prints`` (block, fp) has, once each."""
    owners = max(16, 1 << math.ceil(math.log2(max(1, prints.count() / owner_rows))))
    shift = 64 - owners.bit_length() + 1

    def send(rows: pa.Table) -> pa.Table:
        parts = _by_owner(np.unique(_fingerprints(rows)), shift)
        codes = [golomb_encode(values) for _, values in parts]
        columns = [[rows.column("block")[0].as_py()] * len(parts), [o for o, _ in parts], [len(v) for _, v in parts], [w for w, _ in codes], [c for _, c in codes]]
        return pa.table(columns, schema=pa.schema([("block", pa.int64()), ("owner", pa.int32()), ("n", pa.int32()), ("width", pa.int32()), ("code", pa.binary())]))

    def answer(codes: pa.Table) -> pa.Table:
        sent = [golomb_decode(*x) for x in zip(*(codes.column(c).to_pylist() for c in ("n", "width", "code")), strict=True)]
        values, counts = np.unique(np.concatenate(sent), return_counts=True)
        shared = values[counts > 1]
        bitmaps = [np.packbits(np.isin(x, shared)).tobytes() for x in sent]
        return pa.table([codes.column("block"), codes.column("owner"), pa.array(bitmaps, pa.binary())], names=["block", "owner", "bitmap"])

    def mark(rows: pa.Table, answers: pa.Table) -> pa.Table:
        values, counts = np.unique(_fingerprints(rows), return_counts=True)
        bitmaps = dict(zip(answers.column("owner").to_pylist(), answers.column("bitmap").to_pylist(), strict=True))
        bits = [np.unpackbits(np.frombuffer(bitmaps[o], np.uint8), count=len(v)) for o, v in _by_owner(values, shift)]
        found = values[(np.concatenate(bits) == 1) | (counts > 1)] if bits else values
        return pa.table([pa.array(found.view(np.int64))], names=["fp"])

    sent = prints.groupBy("block").applyInArrow(send, "block long, owner int, n int, width int, code binary")
    answers = sent.groupBy("owner").applyInArrow(answer, "block long, owner int, bitmap binary")
    return prints.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(mark, "fp long").distinct()


def _fp(text: str) -> Column:
    return F.xxhash64(text_of(text))


def groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text", prints: DataFrame | None = None) -> DataFrame:
    """One row for each text that several rows share: ``text_sha256``, ``keep_id`` (largest key), ``group_size``.

    Suspects are found in ``prints`` (block, fp), by default computed from ``docs``. Their number grows with the input, so
    the join is one that shuffles at every size.
    """
    prints = numbered(docs, key=key, text=text) if prints is None else prints
    found = written(suspects(prints.select("block", "fp")), "suspects")
    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"), _fp(text).alias("fp")).join(found.hint("merge"), "fp", "left_semi")
    equal = rows.groupBy("text").agg(F.max("key").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    return written(equal.select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"), "copies")


def numbered(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Written: ``key``, ``row`` (unique), ``block``, ``fp`` and ``text_sha256`` of every row."""
    row = F.monotonically_increasing_id()
    columns = [F.col(key).alias("key"), row.alias("row"), row.bitwiseAND(F.lit(-BLOCK_ROWS)).alias("block"), _fp(text).alias("fp"), F.sha2(text_of(text), 256).alias("text_sha256")]
    return written(docs.select(*columns), "fingerprints")


def by_block(prints: DataFrame, copies: DataFrame) -> DataFrame:
    """Written: the groups of ``copies`` that a block has rows of, and ``keep_row``, the row that stays.

    Each block asks once for a text, however many copies it holds, so that a group of any size stays spread over its blocks.
    """
    best = prints.select("text_sha256", "row", F.col("key").alias("keep_id")).join(
        copies.select(F.col("text_sha256").alias("sha"), F.col("keep_id").alias("best")).hint("merge"),
        (F.col("text_sha256") == F.col("sha")) & F.col("keep_id").eqNullSafe(F.col("best")),
    )
    stays = written(best.groupBy("text_sha256").agg(F.min("row").alias("keep_row")), "keepers")
    asked = prints.select("block", "text_sha256").distinct()
    return written(asked.join(copies.join(stays.hint("merge"), "text_sha256").hint("merge"), "text_sha256"), "copies-by-block")


def exact_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    A NULL text counts as empty. Of equal texts the largest key stays, NULL keys being the smallest. Rows that repeat
    key and text are told apart: one of them is kept. An empty table gives no rows.
    """
    prints = numbered(docs, key=key, text=text)
    copies = by_block(prints, groups(docs, key=key, text=text, prints=prints))
    rows = prints.join(copies.hint("merge"), ["block", "text_sha256"], "left")
    single = F.col("keep_row").isNull()
    return rows.select(
        F.col("key").alias("doc_id"),
        F.when(single, F.col("key")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns. Rows meet their group by text and key: its copies stay spread."""
    prints = numbered(docs, key=key, text=text)
    copies = by_block(prints, groups(docs, key=key, text=text, prints=prints))
    grouped = prints.select("block", "text_sha256", "key").distinct().join(copies.hint("merge"), ["block", "text_sha256"])
    marks = grouped.select(F.col("text_sha256").alias("sha"), F.col("key").alias("marked"), F.col("key").eqNullSafe(F.col("keep_id")).alias("stays")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.sha2(text_of(text), 256).alias("text_sha256"))
    same = (F.col("text_sha256") == F.col("sha")) & F.col("key").eqNullSafe(F.col("marked"))
    joined = rows.join(marks.hint("merge"), same, "left")
    once = joined.where("stays").dropDuplicates(["text_sha256"])
    return joined.where(F.col("stays").isNull()).select("row.*").unionByName(once.select("row.*"))

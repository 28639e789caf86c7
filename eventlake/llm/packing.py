"""Best-fit packing with certified bin counts.

A document's ids are cut only if they exceed a sequence: whole sequences from its end, the rest as its first piece. Pieces
that fill a sequence are done. The others are dealt to partitions; each packs its own by best-fit decreasing and computes a
lower bound of its sequence count by dual-feasible functions. A partition that meets its bound is certified. Partitions with
a gap give the documents of their unfilled sequences into a pool, certified ones those of their emptiest; the pool is dealt
anew to as few partitions as hold it, and packed again while this saves sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import chunks, text_of, written
from eventlake.llm.tokens import CHUNK, REMEMBERED, encoder

SIZE, END = 1024, 2
#: Pieces of a partition, and rounds of exchange at most.
PARTITION_ROWS, ROUNDS = 1 << 15, 4
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END, with_ids: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """The pieces of every row's ids: doc_id, piece, start, length, ids_crc32, and ``ids`` (little-endian uint16) if wanted."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (c for batch in batches for c in chunks(batch, "text", CHUNK)):
            rows = []
            for row, raw in zip(part.column("key").to_pylist(), encoder(tokenizer, remembered).tokenized(part.column("text")), strict=True):
                ids = np.append(np.frombuffer(raw, np.uint16), np.uint16(end))
                first = (len(ids) - 1) % size + 1
                edges = [0, *range(first, len(ids) + 1, size)]
                for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((row, n, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes()), ids[a:b].astype("<u2").tobytes() if with_ids else None))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + with_ids]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    rows = docs.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    return rows.mapInArrow(cut, _PIECE + ", ids binary" * with_ids)


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, taken in the given (falling) order, and the number of bins. A piece goes where it
    leaves least room: the set bits of ``rooms`` are the rooms that occur."""
    free: list[list[int]] = [[] for _ in range(size + 1)]
    rooms, bins = 0, 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, b, bins = size, bins, bins + 1
        where[i], offset[i] = b, size - room
        if room > length:
            free[room - length].append(b)
            rooms |= 1 << (room - length)
    return where, offset, bins


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """The best of three families of dual-feasible functions: the sum of lengths; lengths below a threshold as nothing and
    those that leave less as full; rounded multiples."""
    if not len(lengths):
        return 0
    often = np.bincount(lengths, minlength=size + 1)
    sums, many = np.cumsum(often * np.arange(size + 1)), np.cumsum(often)
    best = -(-int(sums[-1]) // size)
    for low in range(1, size // 2 + 1):
        middle = int(sums[size - low] - sums[low - 1])
        best = max(best, int(many[-1] - many[size - low]) - (-middle // size))
    x = np.arange(size + 1)
    for k in range(1, 21):
        scaled = (k + 1) * x
        value = np.where(scaled % size == 0, x * k, scaled // size * size)  # times k * size
        best = max(best, -(-int((often * value).sum()) // (k * size)))
    return best


def _packed(size: int):
    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = rows.column("length").to_numpy()
        where, offset, bins = best_fit(lengths, size)
        gap = bins - lower_bound(lengths, size)
        fill = np.bincount(where, lengths, bins)
        release = (fill < size) if gap else np.arange(bins) == np.argmin(np.where(fill < size, fill, size + 1))
        release &= fill < size
        columns = {"bin": where, "offset": offset, "gap": np.full(len(rows), gap), "bins": np.full(len(rows), bins), "released": release[where]}
        for name, values in columns.items():
            rows = rows.append_column(name, pa.array(values))
        return rows

    return pack


def _deal(rows: DataFrame, count: int, turn: int, size: int, partition_rows: int) -> DataFrame:
    parts = max(1, -(-count // partition_rows))
    dealt = rows.select("doc_id", "piece", "start", "length", "ids_crc32", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn)), F.lit(parts)).cast("int").alias("part"))
    fields = f"{_PIECE}, part int, bin long, offset long, gap long, bins long, released boolean"
    return written(dealt.groupBy("part").applyInArrow(_packed(size), fields).withColumn("turn", F.lit(turn)), "packed")


def pack(rows: DataFrame, *, size: int = SIZE, partition_rows: int = PARTITION_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """Adds ``sequence_id``, ``offset`` and ``certified`` (the round's partition met its bound) to written pieces."""
    open_rows = rows.where(F.col("length") < size)
    count = open_rows.count()
    done, current = [], _deal(open_rows, count, 0, size, partition_rows)
    for turn in range(1, rounds + 1):
        pool = current.where("released")
        facts = pool.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("part", "bin").alias("bins"), F.sum("length").alias("total")).first()
        if facts["n"] == 0 or facts["bins"] <= -(-facts["total"] // size):
            break
        again = _deal(pool, facts["n"], turn, size, partition_rows)
        bins = again.groupBy("part").agg(F.first("bins").alias("bins")).agg(F.sum("bins")).first()[0]
        if bins >= facts["bins"]:
            break
        done.append(current.where("not released"))
        current = again
    named = ["doc_id", "piece", "start", "length", "ids_crc32"]
    packed = [x.select(*named, "turn", "part", "bin", "offset", (F.col("gap") == 0).alias("certified")) for x in [*done, current]]
    full = rows.where(F.col("length") == size).select(*named, F.lit(-1).alias("turn"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("bin"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))
    out = full
    for x in packed:
        out = out.unionByName(x)
    # (turn, part, bin) as one number: 3 bits, 28 bits, 32 bits; whole sequences have numbers below zero.
    sequence = F.when(F.col("turn") < 0, -F.col("bin") - 1).otherwise(F.shiftleft(F.col("turn").cast("long"), 60) + F.shiftleft(F.col("part").cast("long"), 32) + F.col("bin"))
    return out.select(*named, sequence.alias("sequence_id"), "offset", "certified")


def packed(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified.

    A NULL text is empty: its document is the end id alone. Rows that repeat a key are documents of their own, each with
    pieces from 0. An empty table gives no rows. ``remembered``: words that an encoder keeps, at some 300 bytes each.
    """
    return pack(written(pieces(docs, tokenizer, key=key, text=text, size=size, end=end, remembered=remembered), "pieces"), size=size)


def sequences(docs: DataFrame, tokenizer: str, *, size: int = SIZE, end: int = END) -> DataFrame:
    """The packed sequences themselves: sequence_id, ``ids`` (little-endian uint16, gapless) and the pieces in them."""
    cut = written(pieces(docs, tokenizer, size=size, end=end, with_ids=True), "pieces")
    placed = pack(cut.drop("ids"), size=size)
    # Rows that repeat a key have pieces of the same name; equal ones are interchangeable, which the checksum tells.
    once = cut.groupBy(F.col("doc_id").alias("d"), F.col("piece").alias("p"), F.col("ids_crc32").alias("c")).agg(F.first("ids").alias("ids"))
    joined = placed.join(once, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("piece") == F.col("p")) & (F.col("ids_crc32") == F.col("c")))
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "piece", "length")))
    grouped = joined.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    return grouped.select("sequence_id", ids.alias("ids"), F.transform("parts", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"], x["length"])).alias("pieces"))

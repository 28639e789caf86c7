"""Packing under mixture control: every window gets its share of each source.

1. Texts are encoded once; each source's ids form one queue, in the order of the written rows.
2. All queues are cut at the same points of the mixture into blocks of about ``WINDOWS`` windows. Up to a point a source has
   given its target share of the ids, rounded down to a whole one: what is missing is carried to the next block.
3. A block fills its windows by deficit round-robin: per window a source earns its share of the window. It is served once it
   has earned ``QUANTUM`` ids, or all that it has left; what a window has room for beyond that is lent to the sources that are
   due next. Credits, and debts, go on to the next window.
4. Blocks do not end on windows. The window that a block leaves open is filled by the next block first, so that only the
   very last window of all can be short.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import chunks, text_of, written
from eventlake.llm.tokens import CHUNK, REMEMBERED_ALONE, encoder
from eventlake.operators.ranking import totals_before

SIZE, END = 1024, 0
#: Windows of a block, and ids that a source has earned when it is served.
WINDOWS, QUANTUM = 1024, 128
#: Most rows of the table of (partition, source) totals that are broadcast.
BROADCAST_ROWS = 500_000

_QUEUED = "part int, row long, doc_id long, source string, at long, n long, ids binary"


def queued(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", source: str = "source", text: str = "text", end: int = END) -> DataFrame:
    """Written: every row's ids (little-endian uint16), and ``at``, the ids of its source before it in its partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, totals = TaskContext.get().partitionId(), 0, {}
        tail = np.uint16(end).tobytes()
        for batch in (c for b in batches for c in chunks(b, "text", 2 * CHUNK)):
            ids = [x + tail for x in encoder(tokenizer, REMEMBERED_ALONE).tokenized(batch.column("text"))]
            at = []
            for s, x in zip(batch.column("source").to_pylist(), ids, strict=True):
                at.append(totals.get(s, 0))
                totals[s] = at[-1] + len(x) // 2
            columns = [pa.array(np.full(len(ids), part, np.int32)), pa.array(np.arange(row, row + len(ids))), batch.column("key"), batch.column("source")]
            columns += [pa.array(at, pa.int64()), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            row += len(ids)
            yield pa.RecordBatch.from_arrays(columns, ["part", "row", "doc_id", "source", "at", "n", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(source).cast("string").alias("source"), text_of(text).alias("text"))
    return written(rows.mapInArrow(encode, _QUEUED), "queued")


class Mixture:
    """How many ids each source has given when ``n`` ids of all are out.

    ``weights``: targets of named sources (None names the NULL source). Sources that run dry leave their share to the other
    named ones; after these come all sources without a weight, each by its share of what is left. Without weights every source
    is of the second kind, and the mixture of the whole table holds to the end.
    """

    def __init__(self, total: int, named: dict[str | None, tuple[int, Fraction]]):
        self.total, self.named = total, {s: x for s, x in named.items() if x[0] and x[1] > 0}
        # (ids out, ids given per unit of weight, weight still served), at each point where a source runs dry.
        self.points = [(Fraction(0), Fraction(0), sum((w for _, w in self.named.values()), Fraction(0)))]
        for share, weight in sorted((size / w, w) for size, w in self.named.values()):
            out, given, served = self.points[-1]
            self.points.append((out + (share - given) * served, share, served - weight))
        self.out_named = sum(size for size, _ in self.named.values())

    def given(self, source: str | None, size: int, n: int) -> int:
        """Ids of a source (of ``size`` in all) among the first ``n`` of the mixture, rounded down."""
        if source not in self.named:
            rest = self.total - self.out_named
            return size * max(0, n - self.out_named) // rest if rest else 0
        size, weight = self.named[source]
        out, given, served = max(p for p in self.points if p[0] <= n)
        share = given + (n - out) / served if served else given
        return min(size, int(share * weight))

    def _first(self, source: str | None, size: int, start: int, step: int) -> int:
        """The first block whose end lies behind ``start``."""
        if source not in self.named:  # given(n) > start from n on:
            n = self.out_named + -(-(start + 1) * (self.total - self.out_named) // size)
            return -(-n // step) - 1
        low, high = 0, -(-self.total // step)
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.given(source, size, (middle + 1) * step) > start else (middle + 1, high)
        return low

    def blocks(self, source: str | None, size: int, start: int, length: int, step: int) -> Iterator[tuple[int, int, int]]:
        """The pieces (block, start, length) of a stretch of the source's queue; block ``b`` ends where ``(b + 1) * step`` ids are out."""
        low = self._first(source, size, start, step)
        while length:
            stop = self.given(source, size, min(self.total, (low + 1) * step))
            if stop > start:
                take = min(length, stop - start)
                yield low, start, take
                start, length = start + take, length - take
            low += 1


def served(supplies: list[int], rooms: list[int], quantum: int) -> np.ndarray:
    """Deficit round-robin: how many ids of each source (column) go into each window (row).

    ``rooms``: the windows' sizes, together the supplies. Credits are counted in parts of an id, so nothing is rounded.
    """
    total, left, taken = sum(supplies), list(supplies), [0] * len(supplies)
    out = np.zeros((len(rooms), len(supplies)), np.int64)

    def due(s: int) -> tuple[int, int]:
        """How many ids all sources must have earned until this one has earned a quantum."""
        return -(-(taken[s] + min(quantum, left[s])) * total // supplies[s]), s

    def serve(s: int, most: int) -> int:
        n = min(most, left[s], room)
        out[window, s] += n
        left[s] -= n
        taken[s] += n
        if left[s]:
            heapq.heappush(waiting, due(s))
        return room - n

    waiting = [due(s) for s in range(len(supplies))]
    heapq.heapify(waiting)
    earned = turn = 0
    for window, room in enumerate(rooms):
        earned += room
        ready = []
        while waiting and waiting[0][0] <= earned:
            ready.append(heapq.heappop(waiting)[1])
        ready.sort()
        first = bisect.bisect_left(ready, turn)
        for s in ready[first:] + ready[:first]:
            if room:
                turn = s + 1
            room = serve(s, (earned * supplies[s] - taken[s] * total) // total)
        while room:
            room = serve(heapq.heappop(waiting)[1], quantum)
    return out


def _filled(size: int, quantum: int):
    """Fills a block's windows. ``rows``: the block's pieces of queues; ``blocks``: the ids ``before`` the block."""

    def fill(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        rows = rows.sort_by([("source", "ascending"), ("start", "ascending")])
        lengths = rows.column("length").to_numpy()
        names = pc.dictionary_encode(rows.column("source").combine_chunks(), null_encoding="encode").indices.to_numpy()
        before = blocks.column("before")[0].as_py()
        total = int(lengths.sum())
        first = min(total, -before % size)
        rooms = [r for r in [first, *[size] * ((total - first) // size), (total - first) % size] if r]
        supplies = np.bincount(names, lengths).astype(np.int64)
        plan = served(supplies.tolist(), rooms, quantum)

        # Both cut each source's queue: the documents in it, and the windows that take from it.
        document_ends = np.cumsum(lengths)
        window_ends = (np.cumsum(plan, axis=0) + np.cumsum(supplies) - supplies).T.ravel()
        ends = np.union1d(document_ends, window_ends[plan.T.ravel() > 0])
        starts = np.append(0, ends[:-1])
        doc = np.searchsorted(document_ends, starts, "right")
        queue, window = np.divmod(np.searchsorted(window_ends, starts, "right"), len(rooms))
        # A window is laid out source by source, each beginning with another one.
        order = np.lexsort((starts, (queue - window) % len(supplies), window))
        starts, ends, doc, window = starts[order], ends[order], doc[order], window[order]
        cut = ends - starts
        place = before + np.cumsum(cut) - cut

        raw = np.frombuffer(b"".join(rows.column("ids").to_pylist()), "<u2")
        wide = memoryview(raw.astype("<u4")).cast("B")
        spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
        columns = [rows.column(c).take(pa.array(doc)).combine_chunks() for c in ("doc_id", "source", "doc_tokens")]
        numbers = [rows.column("first").to_numpy()[doc] + starts - (document_ends - lengths)[doc], cut, [zlib.crc32(wide[4 * a : 4 * b]) for a, b in spans], place % size]
        columns += [pa.array(x, pa.int64()) for x in numbers]
        heads = np.flatnonzero(np.diff(window, prepend=-1))
        pieces = pa.ListArray.from_arrays(pa.array([*heads, len(cut)], pa.int32()), pa.StructArray.from_arrays(columns, _PIECE))
        low = raw.tobytes()
        blocks = [b"".join(low[2 * a : 2 * b] for a, b in spans[x:y]) for x, y in zip(heads.tolist(), [*heads[1:].tolist(), len(cut)], strict=True)]
        return pa.table([pa.array(place[heads] // size), pa.array(place[heads] % size), pa.array(blocks, pa.binary()), pieces], names=["sequence_id", "offset", "ids", "pieces"])

    return fill


_PIECE = ["doc_id", "source", "doc_tokens", "start", "length", "ids_crc32", "offset"]
_FILLED = "sequence_id long, offset long, ids binary, pieces array<struct<doc_id:long,source:string,doc_tokens:long,start:long,length:long,ids_crc32:long,offset:long>>"
_CUT = "block long, doc_id long, source string, doc_tokens long, start long, first long, length long"


def filled(
    docs: DataFrame,
    tokenizer: str,
    *,
    weights: dict[str | None, float] | None = None,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    size: int = SIZE,
    end: int = END,
    windows: int = WINDOWS,
    quantum: int = QUANTUM,
) -> DataFrame:
    """The sequences as the blocks fill them: sequence_id, offset, ``ids`` (little-endian uint16) and the pieces in them.

    A window that two blocks fill has two rows; :func:`sequences` joins them. A piece: doc_id, source, doc_tokens (with the
    end id), start, length, ids_crc32, offset. Sequences are numbered from 0 in the order of the mixture; all are full but
    the last. A NULL text is empty: its document is the end id alone. The NULL source is a source of its own. Rows that
    repeat a key are documents of their own. A text of any length is one row in its queue and is cut between blocks. An empty
    table gives no rows. Only one number, and the totals of the sources named in ``weights``, come to the driver.
    """
    rows = queued(docs, tokenizer, key=key, source=source, text=text, end=end)
    parts = written(rows.groupBy("part", "source").agg(F.sum("n").alias("n")), "queue-parts")
    whole = Window.partitionBy("source")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("part").alias("p"), F.col("source").alias("s"), F.sum("n").over(whole).alias("size"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    starts = F.broadcast(starts) if parts.count() <= BROADCAST_ROWS else starts.hint("merge")

    named = {s: Fraction(str(w)) for s, w in (weights or {}).items()}
    wanted = F.col("source").isin([s for s in named if s is not None]) | (F.col("source").isNull() & F.lit(None in named))
    totals = parts.where(wanted).groupBy("source").agg(F.sum("n")).collect() if named else []
    mixture = Mixture(parts.agg(F.sum("n")).first()[0] or 0, {r[0]: (r[1], named[r[0]]) for r in totals})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            out = []
            for i, (s, of, base, at, n) in enumerate(zip(x["source"], x["size"], x["base"], x["at"], x["n"], strict=True)):
                for block, start, length in mixture.blocks(s, of, base + at, n, size * windows):
                    a = start - base - at
                    out.append((block, x["doc_id"][i], s, n, start, a, length, *([x["ids"][i][2 * a : 2 * (a + length)]] if "ids" in x else [])))
            columns = list(zip(*out, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)], schema.names[: len(columns)])

    longs = [pa.field(n, pa.int64()) for n in ("doc_tokens", "start", "first", "length")]
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("source", pa.string()), *longs, ("ids", pa.binary())])
    placed = rows.join(starts, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    needed = ["doc_id", "source", "size", "base", "at", "n"]
    lengths = placed.select(*needed).mapInArrow(cut, _CUT).groupBy("block").agg(F.sum("length").alias("n"))
    blocks = totals_before(lengths, ["block"], ["n"]).select("block", F.col("n_before").alias("before"))
    pieces = placed.select(*needed, "ids").mapInArrow(cut, _CUT + ", ids binary")
    return pieces.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(_filled(size, quantum), _FILLED)


def sequences(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """The sequences, each in one row: sequence_id, ``ids`` and ``pieces``. Options as for :func:`filled`."""
    size = options.get("size", SIZE)
    rows = written(filled(docs, tokenizer, **options), "sequences")
    short = F.octet_length("ids") < 2 * size
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "pieces")))
    joined = rows.where(short).groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    whole = joined.select("sequence_id", ids.alias("ids"), F.flatten(F.transform("parts", lambda x: x["pieces"])).alias("pieces"))
    return rows.where(~short).select("sequence_id", "ids", "pieces").unionByName(whole)


def packed(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """One row per piece of the sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source."""
    rows = filled(docs, tokenizer, **options).select("sequence_id", F.explode("pieces").alias("piece"))
    return rows.select("piece.doc_id", "piece.start", "piece.length", "piece.ids_crc32", "piece.doc_tokens", "sequence_id", "piece.offset", "piece.source")

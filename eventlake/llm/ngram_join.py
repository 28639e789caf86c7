"""N-gram Jaccard join by count vectors.

Documents with the same set of word 5-grams are one *set*. Two sets link when ``9 * shared >= 4 * (n1 + n2)``, that is, at a
Jaccard similarity of 0.8.

1. Every task sends the 64-bit hashes of its sets to owners by hash range, packed, each distinct set once. An owner counts in
   how many sets a hash occurs and returns the hashes that several sets have. Most hashes end here.
2. Hashes are ordered by frequency, rarest first. Linked sets share one of the first ``n // 5 + 1``, so a set whose prefix is
   all its own links with nothing, and common passages stay at the end of the order, outside the prefixes.
3. The sets left are points: their shared hashes fall into ``GROUPS`` groups, the coordinates are the counts. The overlap of
   two points, or of two boxes around points, is at most the sum of their coordinates' minima.
4. In each posting list the points form a tree: the list, boxes around the points already linked with each other, points.
   First each list's points are held against one pivot, which links the bulk of large groups. The pivot is the set whose
   hashes are the most frequent: copies of one text share more with the original than with each other. The next round's
   pivot comes from outside the first one's component. Then all pairs of boxes of a list, and all pairs of their points, are bounded, and verified on the
   hashes if they survive. Points in one box need no pair: their component is known. ``all_links`` keeps these too.

No list is gathered in a task, a large one is split by Spark's skewed join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import chunks, components, text_of, written

#: Words of a shingle. Coordinates of a point. Hashes an owner is meant to hold. Bytes of text hashed at once.
SHINGLE, GROUPS, OWNER_HASHES, CHUNK = 5, 32, 1 << 21, 1 << 22
#: Rounds of pivots before all boxes of a list are compared.
PIVOTS = 1
#: The bound of two points: their coordinates' minima add up to the overlap that a link needs.
OVERLAP = "9 * aggregate(zip_with(point_a, point_b, (x, y) -> least(x, y)), 0, (s, x) -> s + x) >= 4 * (n_a + n_b)"
_MASK = np.uint64((1 << 48) - 1)
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _Words(dict):
    """Hashes of words, kept as long as they are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()


def shingle_hashes(text: str) -> np.ndarray:
    """The sorted hashes of the distinct shingles of a text; of all its words where they are fewer; none without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    width, count = min(SHINGLE, n), max(1, n - SHINGLE + 1)
    mixed = np.full(count, 0x2545F4914F6CDD1D * width % (1 << 64), np.uint64)
    for place in range(width):
        mixed = mixed + (hashes[place : place + count] ^ (hashes[place : place + count] >> np.uint64(29))) * _FACTORS[place]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _set_id(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63)


def members(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Written: ``doc_id``, ``n_shingles`` and ``set_id`` (NULL for the empty set) of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(x.as_py()) for x in batch.column("text")]
            ids = pa.array([_set_id(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([len(s) for s in sets], pa.int64()), ids], ["doc_id", "n_shingles", "set_id"])

    rows = docs.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    return written(rows.mapInArrow(hashed, "doc_id long, n_shingles long, set_id long"), "members")


def _sent(docs: DataFrame, owners: int, text: str) -> DataFrame:
    """The sets' hashes by owner, packed: for each owner the sets of a chunk of texts, their sizes, counts and hashes."""
    names = ["owner", "sets", "sizes", "counts", "low", "high"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in (c for batch in batches for c in chunks(batch, "text", CHUNK)):
            sets = {}
            for x in part.column("text"):
                hashes = shingle_hashes(x.as_py())
                if len(hashes) and (i := _set_id(hashes)) not in seen:
                    sets[i] = hashes
            if not sets:
                continue
            seen = seen | sets.keys() if len(seen) < 200_000 else set(sets)
            ids, sizes = np.array(list(sets), np.int64), np.array([len(x) for x in sets.values()], np.int32)
            hashes, place = np.concatenate(list(sets.values())), np.repeat(np.arange(len(ids)), sizes)
            owner = ((hashes >> np.uint64(40)) * np.uint64(owners) >> np.uint64(24)).astype(np.int32)
            order = np.argsort(owner, kind="stable")
            owner, hashes, place = owner[order], hashes[order] & _MASK, place[order]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            columns: list[list] = [[] for _ in names]
            for a, b in zip(first, [*first[1:], len(owner)], strict=True):
                which, counts = np.unique(place[a:b], return_counts=True)
                values = (int(owner[a]), ids[which], sizes[which], counts.astype(np.int32), hashes[a:b].astype(np.uint32), (hashes[a:b] >> np.uint64(32)).astype(np.uint16))
                for column, value in zip(columns, values, strict=True):
                    column.append(value if isinstance(value, int) else value.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names)

    return docs.select(text_of(text).alias("text")).mapInArrow(packed, "owner int, sets binary, sizes binary, counts binary, low binary, high binary")


def _shared(sent: pa.Table) -> pa.Table:
    """An owner's hashes that several sets have, by set, with their frequency."""

    def joined(column: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(sent.column(column).to_pylist()), kind)

    ids, sizes, counts = joined("sets", np.int64), joined("sizes", np.int32), joined("counts", np.int32)
    hashes = joined("low", np.uint32).astype(np.uint64) | (joined("high", np.uint16).astype(np.uint64) << np.uint64(32))
    once = np.zeros(len(ids), bool)
    once[np.unique(ids, return_index=True)[1]] = True  # a set that several tasks sent counts once
    hashes, which = hashes[np.repeat(once, counts)], np.repeat(np.flatnonzero(once), counts[once])
    _, back, often = np.unique(hashes, return_inverse=True, return_counts=True)
    often = often[back]
    hashes, which, often = hashes[often > 1], which[often > 1], often[often > 1]
    rows, per = np.unique(which, return_counts=True)
    tokens = hashes.astype(np.int64) | (np.int64(sent.column("owner")[0].as_py() & 0x7FFF) << np.int64(48))
    pairs = pa.StructArray.from_arrays([pa.array(often.astype(np.int32)), pa.array(tokens)], ["often", "token"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per)).astype(np.int32)), pairs)
    return pa.table([pa.array(ids[rows]), pa.array(sizes[rows].astype(np.int64)), lists], names=["set_id", "n", "tokens"])


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = [np.bincount(np.asarray(x.values) & (GROUPS - 1), minlength=GROUPS).astype(np.int32) for x in batch.column("tokens")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(points, pa.list_(pa.int32()))], [*batch.schema.names, "point"])


def candidates(docs: DataFrame, owners: int, *, text: str = "text") -> DataFrame:
    """Written: the sets with a prefix that other sets share: ``set_id``, ``n``, ``tokens`` (shared, rarest first),
    ``prefix`` (how many of them), ``weight`` (mean frequency of the set's hashes) and ``point``."""
    shared = _sent(docs, owners, text).groupBy("owner").applyInArrow(_shared, "set_id long, n long, tokens array<struct<often:int,token:long>>")
    sets = shared.groupBy("set_id").agg(F.first("n").alias("n"), F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens"))
    prefix = F.expr("cast(n div 5 + 1 - (n - size(tokens)) as int)")
    weight = F.expr("aggregate(tokens, 0L, (s, t) -> s + t.often) / n").alias("weight")
    rows = sets.withColumn("prefix", prefix).where("prefix > 0").select("set_id", "n", F.col("tokens.token").alias("tokens"), "prefix", weight)
    return written(rows.mapInArrow(_points, "set_id long, n long, tokens array<long>, prefix int, weight double, point array<int>"), "ngram-candidates")


def _near(n1: str, n2: str) -> Column:
    return F.expr(f"5 * least({n1}, {n2}) >= 4 * greatest({n1}, {n2})")


def _verified(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs (a, b) that link. The points' bound comes first, the hashes decide."""
    side = lambda x: points.select(F.col("set_id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "tokens", "point")))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.where(OVERLAP).where("9 * size(array_intersect(tokens_a, tokens_b)) >= 4 * (n_a + n_b)").select("a", "b")


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after new links between sets; ``labels``: node and root of the sets linked so far."""
    root = lambda x: F.coalesce(F.col(f"r{x}"), F.col(x)).alias(x)
    of = lambda x: labels.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(root("a"), root("b")).where("a <> b").distinct()
    joined = components(between)
    above = joined.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = labels.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    added = joined.join(labels, "node", "left_anti")
    return written(moved.unionByName(added.select("node", "root")), "labels")


def _lists(points: DataFrame, labels: DataFrame) -> DataFrame:
    """Written: the posting lists (token, set_id, n, weight, root) that hold sets of more than one component."""
    entries = points.join(labels.select(F.col("node").alias("set_id"), "root"), "set_id", "left").select(
        "set_id", "n", "weight", F.coalesce("root", "set_id").alias("root"), F.explode(F.expr("slice(tokens, 1, prefix)")).alias("token")
    )
    open_lists = entries.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    return written(entries.join(open_lists, "token", "left_semi"), "lists")


def _pivot_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """Each list's pivot with the list's sets of other components."""
    best = F.max(F.struct("weight", F.xxhash64("set_id").alias("tie"), F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"))).alias("p")
    rest = lists
    for _ in range(turn):
        before = rest.groupBy("token").agg(best).select("token", "p.root_a")
        rest = rest.join(before, "token").where(F.col("root") != F.col("root_a")).drop("root_a")
    pivot = rest.groupBy("token").agg(best).select("token", "p.a", "p.n_a", "p.root_a")
    held = lists.join(pivot, "token").where(F.col("root") != F.col("root_a")).where(_near("n", "n_a"))
    return held.select("a", F.col("set_id").alias("b")).distinct()


def _box_pairs(lists: DataFrame, points: DataFrame, all_links: bool = False) -> DataFrame:
    """Pairs of sets in one list whose boxes, and who themselves, may overlap enough."""
    box = "set_id" if all_links else "root"
    entries = lists.withColumn("box", F.col(box)).join(points.select("set_id", "point"), "set_id")
    corner = [F.max(F.col("point")[i]).alias(f"c{i}") for i in range(GROUPS)]
    boxes = written(entries.groupBy("token", "box").agg(F.count(F.lit(1)).alias("points"), F.min("n").alias("low"), F.max("n").alias("high"), *corner), "boxes")
    one, two = boxes.alias("x"), boxes.alias("y")
    minima = " + ".join(f"least(x.c{i}, y.c{i})" for i in range(GROUPS))
    close = F.expr(f"x.box < y.box and 5 * x.high >= 4 * y.low and 5 * y.high >= 4 * x.low and 9 * ({minima}) >= 4 * (x.low + y.low)")
    fewer = F.col("x.points") <= F.col("y.points")  # the smaller box is opened first
    pairs = one.join(two, (F.col("x.token") == F.col("y.token")) & close).select(
        F.col("x.token").alias("token_a"), F.when(fewer, F.col("x.box")).otherwise(F.col("y.box")).alias("box_a"), F.when(fewer, F.col("y.box")).otherwise(F.col("x.box")).alias("box_b")
    )
    side = lambda x: entries.select(F.col("token").alias(f"t_{x}"), F.col("box").alias(f"of_{x}"), F.col("set_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("point").alias(f"point_{x}"))
    opened = pairs.join(side("a"), (F.col("token_a") == F.col("t_a")) & (F.col("box_a") == F.col("of_a")))
    meet = (F.col("token_a") == F.col("t_b")) & (F.col("box_b") == F.col("of_b")) & _near("n_a", "n_b") & F.expr(OVERLAP)
    return opened.join(side("b"), meet).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _owners(rows: DataFrame) -> int:
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    return max(64, math.ceil(total / OWNER_HASHES))


def links(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links between different sets (a, b), and the membership (doc_id, n_shingles, set_id)."""
    rows = members(docs, key=key, text=text)
    points = candidates(docs, _owners(rows), text=text)
    none = points.select(F.col("set_id").alias("node"), F.col("set_id").alias("root")).limit(0)
    return written(_verified(_box_pairs(_lists(points, none), points, True), points), "links"), rows


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest key reachable by links, itself included).

    A text without words, or NULL, has an empty set and links with nothing. Keys are integers; a NULL key never names a
    component, unless all keys of the component are NULL. Rows that repeat a key are separate members. An empty table gives no rows.
    """
    rows = members(docs, key=key, text=text)
    points = candidates(docs, _owners(rows), text=text)
    labels = written(points.select(F.col("set_id").alias("node"), F.col("set_id").alias("root")).limit(0), "labels")
    for turn in range(PIVOTS + 1):
        lists = _lists(points, labels)
        if lists.isEmpty():
            break
        pairs = _pivot_pairs(lists, turn) if turn < PIVOTS else _box_pairs(lists, points)
        found = written(_verified(pairs, points), "links")
        if not found.isEmpty():
            labels = _merge(labels, found)
    named = rows.join(labels.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    smallest = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least")).where("least is not null")
    joined = named.join(written(smallest, "smallest"), "root", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key names their component, all columns. Rows that share a key share its fate: they stay
    if one of them stays. Rows with a NULL key stay."""
    found = near_duplicates(docs, key=key, text=text).where("doc_id is not null")
    gone = found.groupBy(F.col("doc_id").alias(key)).agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("gone")).where("gone").select(key)
    return docs.join(written(gone, "gone"), key, "left_anti")

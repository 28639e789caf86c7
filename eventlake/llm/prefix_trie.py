"""The prefix trie of rebuilt conversations, by composable fingerprints.

A rebuilt conversation takes its head from another one's stored turns and goes on with its own. A turn is an element of a
monoid: the affine map ``x -> a x + b`` over a prime field, drawn from its digest; a sequence of turns is the product of its
elements. Products are taken once along the stored turns, over ranges of the sorted table, so a conversation of any length is
spread over tasks. The product of a rebuilt prefix is then put together from those of its parts, ``head * own[:h]^-1 *
own[:j]``: no rebuilt text exists anywhere.

Members of a node are the rebuilt conversations with one product at one depth. Their equality is verified: all members refer
to stored turns of one class and to one parent, and a class holds one role and text, compared as they are stored. Where this
fails, the elements are drawn anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import text_of, written
from eventlake.llm.scans import in_ranges

#: The field, and the two maps (a, b, a, b) of a product.
PRIME = (1 << 31) - 1
IDENTITY = (1, 0, 1, 0)
#: Turns copied from another conversation at most.
HEAD = 3
#: Parents that are looked up by broadcast: those with more than one in ``HOT_PARENTS`` of all nodes as children, which are at most as many.
HOT_PARENTS = 100_000
#: Identifiers in one row on the way to a node's digest, and times that elements are drawn.
CHUNK_IDS, DRAWS = 1 << 16, 3

Product = tuple[int, int, int, int]
_PRODUCT = "struct<a0:long,b0:long,a1:long,b1:long>"
_ARROW_PRODUCT = pa.struct([(n, pa.int64()) for n in ("a0", "b0", "a1", "b1")])
_NODE = ["depth", "x", "y"]


class CollisionError(RuntimeError):
    """Different prefixes have one product, whichever elements were drawn."""


def product(x: Product, y: Product) -> Product:
    return x[0] * y[0] % PRIME, (x[0] * y[1] + x[1]) % PRIME, x[2] * y[2] % PRIME, (x[2] * y[3] + x[3]) % PRIME


def inverse(x: Product) -> Product:
    a0, a1 = pow(x[0], -1, PRIME), pow(x[2], -1, PRIME)
    return a0, -x[1] * a0 % PRIME, a1, -x[3] * a1 % PRIME


def element(digest: bytes) -> Product:
    """The element of a turn's digest; both maps can be inverted."""
    a0, b0, a1, b1 = (int.from_bytes(digest[i : i + 8], "little") for i in (0, 8, 16, 24))
    return a0 % (PRIME - 1) + 1, b0 % PRIME, a1 % (PRIME - 1) + 1, b1 % PRIME


def _products(values: list[Product]) -> pa.StructArray:
    columns = zip(*values, strict=True) if values else [()] * 4
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_ARROW_PRODUCT))


def _unit() -> Column:
    return F.struct(*(F.lit(v).cast("long").alias(n) for n, v in zip(("a0", "b0", "a1", "b1"), IDENTITY, strict=True)))


def _times(x: Column, y: Column) -> Column:
    """:func:`product` of two struct columns; all numbers are below 2^31."""
    out = []
    for a, b in (("a0", "b0"), ("a1", "b1")):
        out += [(x[a] * y[a] % PRIME).alias(a), ((x[a] * y[b] + x[b]) % PRIME).alias(b)]
    return F.struct(*out)


def _named(value: Column, x: str = "x", y: str = "y") -> list[Column]:
    """A product as two numbers."""
    return [F.shiftleft(value[a], 31).bitwiseOR(value[b]).alias(n) for n, a, b in ((x, "a0", "b0"), (y, "a1", "b1"))]


def stored_turns(rows: DataFrame, draw: int, *, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Written: every turn in its order with its range ``part`` and ``place``, its class (``r0``, ``r1``), ``n_words``, and the
    products of its conversation's turns in this range, without it (``p``) and with it (``q``)."""
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("sha")]
    turns = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("conv"), F.col(turn).alias("turn"), text_of(role).alias("role"), text_of(text).alias("text"))
    salt = draw.to_bytes(8, "little")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, conv, total = TaskContext.get().partitionId(), 0, None, IDENTITY
        for batch in batches:
            before, after, r0, r1 = [], [], [], []
            for c, role_, sha in zip(*(batch.column(n).to_pylist() for n in ("conv", "role", "sha")), strict=True):
                digest = hashlib.blake2b(f"{len(role_)}:{role_}{sha}".encode("utf-8", "surrogatepass"), digest_size=32, salt=salt).digest()
                before.append(total if c == conv else IDENTITY)
                conv, total = c, product(before[-1], element(digest))
                after.append(total)
                r0.append(int.from_bytes(digest[:8], "little", signed=True))
                r1.append(int.from_bytes(digest[8:16], "little", signed=True))
            n = batch.num_rows
            columns = [pa.array([part] * n, pa.int32()), pa.array(range(place, place + n), pa.int64()), pa.array(r0, pa.int64()), pa.array(r1, pa.int64()), _products(before), _products(after)]
            place += n
            given = ["conv", "n_words", "role", "text"]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in given)], ["part", "place", "r0", "r1", "p", "q", *given])

    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    ordered = turns.withColumns({"sha": F.sha2("text", 256), "n_words": words}).repartitionByRange(*order).sortWithinPartitions(*order)
    fields = f"part int, place long, r0 long, r1 long, p {_PRODUCT}, q {_PRODUCT}, conv long, n_words long, role string, text string"
    return written(ordered.select("conv", "role", "sha", "n_words", "text").mapInArrow(scan, fields), "turns")


def _segments(turns: DataFrame) -> DataFrame:
    """Written: for each conversation and range its ``first`` place there, the turns ``before`` it in earlier ranges, their
    product ``k``, and the conversation's ``size``. A conversation has one for each range that holds it."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, total = None, IDENTITY
        for batch in batches:
            out = []
            for c, q in zip(batch.column("conv").to_pylist(), batch.column("q").to_pylist(), strict=True):
                out.append(total if c == conv else IDENTITY)
                conv, total = c, product(out[-1], tuple(q.values()))
            given = ["part", "conv", "first", "size", "before"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in given), _products(out)], [*given, "k"])

    whole = Window.partitionBy("conv")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    found = turns.groupBy("part", "conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.max_by("q", "place").alias("q")).repartition("conv")
    counted = found.select("part", "conv", "first", F.sum("n").over(whole).alias("size"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), "q")
    return written(counted.sortWithinPartitions("conv", "part").mapInArrow(fold, f"part int, conv long, first long, size long, before long, k {_PRODUCT}"), "segments")


def _rebuilt(segments: DataFrame, heads: DataFrame, base: Column, head: Column) -> DataFrame:
    """Written: one row per conversation: ``conv``, ``size``, the turns ``h`` that it leaves out of its own, the stored turns
    it begins with (``begins``), and ``c``, the product that turns one of its own prefixes into a rebuilt one."""

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("taken").to_pylist(), batch.column("left").to_pylist(), strict=True)
            c = [product(tuple(x.values()), inverse(tuple(y.values()))) for x, y in both]
            given = ["conv", "size", "h", "begins"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in given), _products(c)], [*given, "c"])

    def last(turns: Column, n: Column) -> Column:
        return F.when(n > 0, F.try_element_at(turns, n.cast("int"))["q"]).otherwise(_unit())

    conversations = segments.where("before = 0").select("conv", "size").join(heads, "conv")
    named = conversations.select("conv", "size", "turns", base.alias("base"), F.least(head, F.lit(HEAD)).cast("long").alias("h"))
    bases = heads.select(F.col("conv").alias("base"), F.col("turns").alias("base_turns"))
    met = named.join(bases, "base", "left").select("conv", "size", "h", "turns", F.coalesce(F.expr("slice(base_turns, 1, cast(h as int))"), F.expr("slice(turns, 1, 0)")).alias("begins"))
    rows = met.select("conv", "size", "h", "begins", last(F.col("begins"), F.size("begins")).alias("taken"), last(F.col("turns"), F.least("h", "size")).alias("left"))
    begins = f"array<struct<at:long,p:{_PRODUCT},q:{_PRODUCT},n_words:long,r0:long,r1:long>>"
    return written(rows.mapInArrow(divide, f"conv long, size long, h long, begins {begins}, c {_PRODUCT}"), "rebuilt")


def members(turns: DataFrame, base: Column, head: Column) -> DataFrame:
    """Written: every prefix of every rebuilt conversation, the empty one included: ``conv``, ``depth``, its name (``x``, ``y``)
    and its parent's (``px``, ``py``), the class and words of its last turn, and whether the conversation ends with it."""
    segments = _segments(turns)
    at = F.col("before") + F.col("place") - F.col("first")
    own = turns.drop("role", "text").join(segments, ["part", "conv"])
    whole = own.select("conv", at.alias("at"), _times(F.col("k"), F.col("p")).alias("p"), _times(F.col("k"), F.col("q")).alias("q"), "n_words", "r0", "r1")
    # Of each range only the first places of a conversation can hold its first turns.
    first = whole.where(F.col("at") < HEAD).groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("at", "p", "q", "n_words", "r0", "r1"))).alias("turns"))
    rebuilt = _rebuilt(segments, written(first, "heads"), base, head)

    begun, kept = F.size("begins").cast("long"), F.greatest(F.col("size") - F.col("h"), F.lit(0))
    facts = rebuilt.select("conv", "h", begun.alias("begun"), (begun + kept).alias("deepest"), "c")
    parts = segments.join(facts, "conv").select("part", "conv", "first", "before", "h", "begun", "deepest", _times(F.col("c"), F.col("k")).alias("g"))
    mine = turns.drop("role", "text").join(parts, ["part", "conv"]).where(at >= F.col("h"))
    depth = F.col("begun") + at - F.col("h") + 1
    mine = mine.select("conv", depth.alias("depth"), *_named(_times(F.col("g"), F.col("q"))), *_named(_times(F.col("g"), F.col("p")), "px", "py"), "n_words", "r0", "r1", (depth == F.col("deepest")).alias("ends"))

    deepest = begun + kept
    taken = rebuilt.select("conv", deepest.alias("deepest"), F.posexplode("begins").alias("pos", "t"))
    depth = F.col("pos").cast("long") + 1
    taken = taken.select("conv", depth.alias("depth"), *_named(F.col("t.q")), *_named(F.col("t.p"), "px", "py"), "t.n_words", "t.r0", "t.r1", (depth == F.col("deepest")).alias("ends"))
    none = F.lit(0).cast("long")
    root = rebuilt.select("conv", none.alias("depth"), *_named(_unit()), none.alias("px"), none.alias("py"), none.alias("n_words"), none.alias("r0"), none.alias("r1"), (deepest == 0).alias("ends"))
    return written(mine.unionByName(taken).unionByName(root), "members")


def _nodes(found: DataFrame) -> DataFrame:
    """Written: one row per name, with what its members agree on (``one``: they do)."""
    same = [F.min(c) == F.max(c) for c in ("px", "py", "r0", "r1")]
    facts = [F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("px").alias("px"), F.min("py").alias("py"), F.min("n_words").alias("n_words")]
    return written(found.groupBy(*_NODE).agg(*facts, (same[0] & same[1] & same[2] & same[3]).alias("one")), "nodes")


def _one_text_each(turns: DataFrame) -> bool:
    """Whether all turns of a class have one role and text."""
    return turns.select("r0", "r1", "role", "text").distinct().groupBy("r0", "r1").count().where("count > 1").isEmpty()


def _below(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """Leaves and saved words of each node's subtree.

    A node counts where its smallest member passes it, so a subtree's sum is the sum over its members of what each counts at
    this depth and below: a running sum along the conversation, over sorted ranges.
    """
    counted = nodes.select(F.col("conv_id").alias("conv"), "depth", ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    amounts = found.select("conv", *_NODE).join(counted, ["conv", "depth"], "left").fillna(0, ["saved", "leaf"])
    rows = in_ranges(amounts, [F.asc("conv"), F.asc("depth")], "amounts")
    later = Window.partitionBy("conv").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("part", "conv").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    sums = sums.select("part", "conv", *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in ("saved", "leaf")))
    onward = Window.partitionBy("part", "conv").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.select("part", *_NODE, "conv", *(F.sum(c).over(onward).alias(c) for c in ("saved", "leaf"))).join(sums, ["part", "conv"])
    return running.groupBy(*_NODE).agg(F.sum(F.col("saved") + F.col("saved_later")).alias("saved_tokens"), F.sum(F.col("leaf") + F.col("leaf_later")).alias("n_leaves"))


def _ends(found: DataFrame) -> DataFrame:
    """The digest of the conversations that end with a node: identifiers are sorted over all, joined in rows of many, and
    hashed as they stream by. A digest is one sequence of bytes: its rows meet in one task, which holds one of them at a time."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({**{n: pa.array([v], pa.int64()) for n, v in zip([*_NODE, "first"], [*node, ids[0]], strict=True)}, "ids": [",".join(map(str, ids))]})

        for batch in batches:
            out = []
            for *name, conv in zip(*(batch.column(n).to_pylist() for n in [*_NODE, "conv"]), strict=True):
                if name != node or len(ids) == CHUNK_IDS:
                    if ids:
                        out.append(row())
                    node, ids = name, []
                ids.append(conv)
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if ids:
            yield row()

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def rows(out: list) -> pa.RecordBatch:
            names, digests = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in zip(*names, strict=True)), pa.array(digests)], [*_NODE, "ends_sha256"])

        for batch in batches:
            out = []
            for *name, ids in zip(*(batch.column(n).to_pylist() for n in [*_NODE, "ids"]), strict=True):
                if name == node:
                    digest.update(b",")
                else:
                    if node:
                        out.append((node, digest.hexdigest()))
                    node, digest = name, hashlib.sha256()
                digest.update(ids.encode())
            if out:
                yield rows(out)
        if node:
            yield rows([(node, digest.hexdigest())])

    order = [*_NODE, "conv"]
    ends = found.where("ends").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = ends.mapInArrow(join, "depth long, x long, y long, first long, ids string")
    return joined.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(hash_, "depth long, x long, y long, ends_sha256 string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Adds ``parent_conv_id``. Parents with very many children are looked up by broadcast, so no key of the join is hot."""
    hot = max(1, nodes.count() // HOT_PARENTS)
    up = nodes.select((F.col("depth") + 1).alias("d"), F.col("x").alias("ux"), F.col("y").alias("uy"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("of"))
    same = (F.col("depth") == F.col("d")) & (F.col("px") == F.col("ux")) & (F.col("py") == F.col("uy"))
    lower = nodes.where("depth > 0")
    many = F.broadcast(up.where(F.col("of") > hot))
    near = lower.join(many, same)
    far = lower.join(many, same, "left_anti").join(up.where(F.col("of") <= hot).hint("merge"), same)
    root = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return near.select(*root.columns).unionByName(far.select(*root.columns)).unionByName(root)


def trie(
    rows: DataFrame,
    *,
    base: Column | None = None,
    head: Column | None = None,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation is rebuilt from the first ``head`` turns (0 to 3) of conversation ``base`` and its own turns after as many;
    both are expressions of the column ``conv``, by default it stays as it is. Turns go by ``turn``, NULL first, ties by role
    and the text's SHA-256; a repeated row is a turn of its own. NULL roles and texts are empty. Rows without a conversation
    are in none. An empty table gives no rows. Conversations and groups of any size are spread over tasks; a text is held by
    one task at a time.
    """
    base = F.col("conv") if base is None else base
    head = F.lit(0) if head is None else head
    for draw in range(DRAWS):
        turns = stored_turns(rows, draw, key=key, turn=turn, role=role, text=text)
        found = members(turns, base, head)
        nodes = _nodes(found)
        if nodes.where(~F.col("one")).isEmpty() and _one_text_each(turns):
            break
    else:
        raise CollisionError(f"{DRAWS} draws of elements")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, _NODE, "left").fillna(0, ["n_children"]), "nodes")
    whole = _with_parents(nodes).join(_below(found, nodes), _NODE).join(_ends(found), _NODE, "left")
    digest = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest.alias("ends_sha256"))


def families(rows: DataFrame) -> DataFrame:
    """The trie of conversations that begin as the first of their twenty does, with up to three of its turns."""
    conv = F.col("conv")
    return trie(rows, base=conv - conv % 20, head=F.crc32(conv.cast("string")) % 4)

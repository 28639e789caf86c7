"""A Merkle manifest of a data set: one tree of digests for each source, and one over the sources' roots.

Nodes are labelled by the interval of leaf ranks that they cover, ``[lo, hi)``. Built upwards, every 16 consecutive nodes of a
level become one of the next. Ancestors are attached downwards by containment joins: rows meet in the bucket of ranks that a
node of the level above covers, and there the parent is the node whose interval contains theirs. A node's siblings are the
parent's children less its own interval: those that end before it and those that begin after it. A leaf's proof holds its
siblings and those of its ancestors, so its digest can be folded up to the root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import written
from eventlake.llm.scans import in_ranges, key_segments

#: Nodes of a run, as a power of two.
RUN_BITS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NO_PATH = "array<struct<before:string,after:string>>"


def digest_of(*values: Column) -> Column:
    """SHA-256 (lowercase hex) of values: ``-`` for NULL, else length in UTF-8 bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["digest"]), "")


def tree(leaves: DataFrame) -> list[DataFrame]:
    """The levels above ``leaves`` (tree, size, lo, hi, digest), leaves first, each written.

    ``size``: leaves of the tree. A tree ends with the level on which one node covers it.
    """
    levels = [leaves]
    most = leaves.agg(F.max("size")).first()[0] or 0
    while most > 1 << RUN_BITS * (len(levels) - 1):
        depth = len(levels)
        below = levels[-1].where(F.col("size") > 1 << RUN_BITS * (depth - 1))
        runs = below.groupBy("tree", "size", F.shiftright("lo", RUN_BITS * depth).alias("bucket"))
        grouped = runs.agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        nodes = grouped.select("tree", "size", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"), F.sha2(_joined(F.col("kids")), 256).alias("digest"), "kids")
        levels.append(written(nodes, "merkle-level"))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the nodes that cover their tree."""
    covering = [x.where(F.col("hi") - F.col("lo") == F.col("size")).select("tree", "digest") for x in levels]
    # A tree of one leaf is its own root; larger ones have one covering node, on their last level.
    return reduce(DataFrame.unionByName, covering)


def with_paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with ``path``: (before, after), the digests of the siblings on both sides, level by level up to the tree's
    root and on along the root's own path. ``tops``: tree, path and any columns that all leaves of a tree get."""
    above = None
    given = [c for c in tops.columns if c not in ("tree", "path")]
    for depth in range(len(levels) - 1, -1, -1):
        nodes = levels[depth]
        found = nodes.where(F.col("hi") - F.col("lo") == F.col("size")).join(tops, "tree")
        if above is not None:
            bucket = RUN_BITS * (depth + 1)
            parents = above.select(F.col("tree").alias("p_tree"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), F.col("kids").alias("p_kids"), F.col("path").alias("p_path"), *given)
            below = nodes.where(F.col("hi") - F.col("lo") < F.col("size"))
            inside = (F.col("lo") >= F.col("p_lo")) & (F.col("hi") <= F.col("p_hi"))
            met = below.join(parents, (F.col("tree") == F.col("p_tree")) & (F.shiftright("lo", bucket) == F.shiftright("p_lo", bucket)) & inside)
            before = _joined(F.filter("p_kids", lambda k: k["hi"] <= F.col("lo")))
            after = _joined(F.filter("p_kids", lambda k: k["lo"] >= F.col("hi")))
            path = F.concat(F.array(F.struct(before.alias("before"), after.alias("after"))), F.col("p_path"))
            found = found.unionByName(met.withColumn("path", path).select(*found.columns))
        above = written(found, "merkle-paths") if depth else found
    return above


def proof(path: Column) -> Column:
    """SHA-256 of the path's digests, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest gives with the siblings of its path."""
    return F.aggregate(path, leaf, lambda digest, x: F.sha2(F.concat(x["before"], digest, x["after"]), 256))


def manifest(docs: DataFrame, *, key: str = "doc_id", source: str = "source", fields: tuple[str, ...] = FIELDS, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: the key, source, ``rank`` in its source, ``leaf``, ``path``, ``subroot``, ``root`` and
    ``extra``, columns computed from the row (small ones: they are sorted with it).

    A leaf is the digest of ``fields``. Leaves ascend by key in their source, NULL keys first; rows with one key by their
    digests, so repeated rows have equal leaves. Sources ascend bytewise, NULL first. An empty table gives no rows.
    Texts stay where they are read, whatever their length; a source of any size is ranked over many ranges.
    """
    columns = {"k": F.col(key), "s": F.col(source), "leaf": digest_of(*(F.col(c) for c in fields)), **{f"x_{n}": c for n, c in (extra or {}).items()}}
    rows = in_ranges(docs.select(*(c.alias(n) for n, c in columns.items())), [F.asc_nulls_first("s"), F.asc_nulls_first("k"), F.asc("leaf")], "merkle-leaves")
    segments = key_segments(rows, "s")
    named = in_ranges(segments.select("s", "size").distinct().withColumn("all", F.lit(0)), [F.asc_nulls_first("s")], "merkle-sources")
    of_all = key_segments(named, "all").select("part", "first", "before", F.col("size").alias("sources"))
    at = F.col("before") + F.col("place") - F.col("first")
    sources = written(named.join(of_all, "part").select("s", "size", "sources", at.alias("tree")), "merkle-trees")

    placed = segments.select(F.col("part").alias("in"), F.col("s").alias("of"), "first", "before").join(sources, F.col("of").eqNullSafe(F.col("s"))).drop("s")
    own = rows.join(placed, (F.col("part") == F.col("in")) & F.col("s").eqNullSafe(F.col("of")))
    leaves = written(own.select("tree", "size", at.alias("lo"), (at + 1).alias("hi"), F.col("leaf").alias("digest"), "k", "s", *(f"x_{n}" for n in extra or {})), "merkle-leaves")

    levels = tree(leaves)
    subroots = written(roots(levels).join(sources.select("tree", "sources"), "tree"), "merkle-subroots")
    upper = tree(subroots.select(F.lit(0).alias("tree"), F.col("sources").alias("size"), F.col("tree").alias("lo"), (F.col("tree") + 1).alias("hi"), "digest"))
    tops = with_paths(upper, roots(upper).select("tree", F.array().cast(_NO_PATH).alias("path"), F.col("digest").alias("root")))
    tops = written(tops.select(F.col("lo").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "merkle-tops")
    found = with_paths(levels, tops)
    return found.select(F.col("k").alias(key), F.col("s").alias(source), F.col("lo").alias("rank"), F.col("digest").alias("leaf"), "path", "subroot", "root", *(F.col(f"x_{n}").alias(n) for n in extra or {}))


def lowered(text: Column) -> Column:
    """A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def tampered_rows(docs: DataFrame) -> DataFrame:
    """Every document's proof, checked against the row as found: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Where 5 divides the CRC-32 of the decimal doc_id, the row is found with its text lower-cased (A-Z); NULL texts, and rows
    with a NULL doc_id, are found as they were.
    """
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    found = [F.when(hit, lowered(F.col(c))).otherwise(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    rows = manifest(docs, extra={"found": digest_of(*found)})
    checked = rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded(F.col("found"), F.col("path")).alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))

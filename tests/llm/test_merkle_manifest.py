"""The Merkle manifest against a plain recomputation, and its proofs on shapes of trees."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventlake.llm import merkle_manifest

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _climb(digests):
    """The root, and for each digest its proof: siblings before and after, level by level."""
    proofs, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, p in enumerate(at):
            run = p // 16 * 16
            proofs[i].append(("".join(digests[run:p]), "".join(digests[p + 1 : run + 16])))
        digests, at = [_h(*digests[i : i + 16]) for i in range(0, len(digests), 16)], [p // 16 for p in at]
    return digests[0], proofs


def _expected(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append(((row[0] is not None, row[0] or 0), _leaf(row), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        trees[s].sort(key=lambda x: x[:2])
    climbed = {s: _climb([x[1] for x in trees[s]]) for s in names}
    root, upper = _climb([climbed[s][0] for s in names])
    out = []
    for s, up in zip(names, upper, strict=True):
        for (_, leaf, row), own in zip(trees[s], climbed[s][1], strict=True):
            path = own + up
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            text = re.sub("[A-Z]", lambda m: m[0].lower(), row[4]) if hit and row[4] is not None else row[4]
            got = _leaf((*row[:4], text))
            for before, after in path:
                got = _h(before, got, after)
            out.append((row[0], leaf, climbed[s][0], root, _h(*(b + a for b, a in path)), got, got == root))
    return out


def _key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def _same(got, rows):
    assert sorted((tuple(r) for r in got), key=_key) == sorted(_expected(rows), key=_key)


def test_the_registered_query_matches_a_plain_recomputation(run, sample):
    got = run("op12_merkle_manifest")
    _same([tuple(r[c] for c in COLUMNS) for r in got], sample("documents", "doc_id", "source", "lang", "n_chars", "text"))
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 2, 16, 17, 33], [300], [1] * 20])
def test_every_shape_of_tree(spark, sizes):
    rows = [(n * 1000 + i, f"s{n}", "en", i, f"Text {i}") for n, size in enumerate(sizes) for i in range(size)]
    _same(_run(spark, rows), rows)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def _run(spark, rows, schema=SCHEMA):
    return merkle_manifest.tampered_rows(spark.createDataFrame(rows, schema)).select(*COLUMNS).collect()


def test_nulls_ties_repeated_rows_and_long_texts(spark):
    rows = [(None, None, None, None, None), (0, None, "en", 0, ""), (1, "Å", "en", 2, "É:A"), (1, "Å", "en", 2, "É:A"), (1, "Å", "de", 2, "other"), (2, "Z", None, -7, None)]
    rows += [(5, "a", "en", 1, "A" * 300_000), (5, "", "en", 1, "-"), (None, "a", "en", 1, "X"), (-40, "a", "en", 1, "B")]
    _same(_run(spark, rows), rows)
    assert _run(spark, rows[:0]) == []


def test_columns_of_clashing_names(spark):
    rows = [(i, f"s{i % 2}", "en", i, f"T{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "part", "place", "size", "lo", "hi", "digest", "path", "root", "k", "s", "kids", "found", "leaf"):
        docs = docs.withColumn(name, F.lit("x"))
    _same(merkle_manifest.tampered_rows(docs).select(*COLUMNS).collect(), rows)


def test_nodes_carry_intervals_and_siblings_tile_the_parent(spark):
    rows = [(i, "a" if i % 3 else "b", "en", i, f"T{i}") for i in range(700)]
    got = merkle_manifest.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.source, r["rank"]) for r in got) == [(s, i) for s, n in (("a", 466), ("b", 234)) for i in range(n)]
    for r in got:
        inner = r.path[:-1]  # the last step joins the two sources
        covered = 1
        for step in inner:
            covered = covered and (len(step.before) + len(step.after)) // 64 + 1
            assert 1 <= covered <= 16
        assert (len(r.path[-1].before), len(r.path[-1].after)) == ((0, 64) if r.source == "a" else (64, 0))

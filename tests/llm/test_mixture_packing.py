"""Mixture-controlled packing: every id once, full windows, and each source's share in every window."""

from __future__ import annotations

import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventlake.llm import mixture_packing
from eventlake.llm.mixture_packing import Mixture, packed, sequences, served
from eventlake.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def _ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def _holds(rows, docs, tokenizer, size=1024):
    """Every id of every document in exactly one piece, sequences gapless, all full but the last."""
    todo = defaultdict(list)
    for key, text in docs:
        todo[key].append(_ids(tokenizer, text))
    assert all(len(x) == 1 for x in todo.values())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        ids = todo[r.doc_id][0]
        assert r.length > 0 and r.doc_tokens == len(ids) and r.ids_crc32 == _crc(ids[r.start : r.start + r.length])
    assert set(by_doc) == set(todo)
    for key, pieces in by_doc.items():
        spans = sorted((p.start, p.start + p.length) for p in pieces)
        assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == len(todo[key][0])
    total = sum(len(x[0]) for x in todo.values())
    assert sorted(by_sequence) == list(range(-(-total // size)))
    for number, pieces in by_sequence.items():
        spans = sorted((p.offset, p.offset + p.length) for p in pieces)
        assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == min(size, total - number * size)


def test_the_registered_query_holds_every_id_once(run, sample, tokenizer):
    _holds(run("op13_mixture_packing"), sample("documents", "doc_id", "text"), tokenizer)


def _corpus(spark, sizes, words=40):
    rows = [(n * 10_000 + i, "word " * (words + i % 7), "en", s) for n, (s, size) in enumerate(sizes.items()) for i in range(size)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def _given(rows, size):
    counts = defaultdict(lambda: defaultdict(int))
    for r in rows:
        counts[r.sequence_id][r.source] += r.length
    return [counts[i] for i in sorted(counts)]


@pytest.mark.parametrize("windows", [3, 64])
def test_every_window_holds_the_mixture_and_credits_go_on(spark, tokenizer, windows):
    corpus, docs = _corpus(spark, {"hot": 600, "a": 150, "b": 149, None: 100, "rare": 2})
    rows = packed(docs.repartition(5), TOKENIZER, size=256, windows=windows, quantum=16).collect()
    _holds(rows, [(k, t) for k, t, _, _ in corpus], tokenizer, 256)
    shares = defaultdict(int)
    for k, t, _, s in corpus:
        shares[s] += len(_ids(tokenizer, t))
    total, seen, out = sum(shares.values()), defaultdict(int), 0
    for window in _given(rows, 256):
        for s, n in window.items():
            seen[s] += n
        out += sum(window.values())
        # A source may wait for a quantum; what the waiting ones are owed is lent to one other.
        assert all(abs(seen[s] - out * shares[s] / total) <= 16 * len(shares) for s in shares)


def test_targets_hold_until_a_source_runs_dry(spark, tokenizer):
    corpus, docs = _corpus(spark, {"x": 300, "y": 300, "z": 300})
    rows = packed(docs, TOKENIZER, weights={"x": 2, "y": 1}, size=128, windows=8, quantum=8).collect()
    _holds(rows, [(k, t) for k, t, _, _ in corpus], tokenizer, 128)
    windows = _given(rows, 128)
    each = sum(len(_ids(tokenizer, t)) for _, t, _, s in corpus if s == "x")
    mixed, dry, rest = each * 3 // 2 // 128, each * 2 // 128, len(windows)
    for i in range(mixed // 8 * 8):
        assert abs(windows[i]["x"] - 128 * 2 / 3) <= 24 and windows[i]["z"] == 0
    assert all(windows[i]["y"] == 128 for i in range(mixed + 9, dry // 8 * 8))
    assert all(windows[i]["z"] == 128 for i in range(dry + 9, rest - 1))


def test_mixture_points():
    mixture = Mixture(1000, {"a": (100, Fraction(1)), None: (300, Fraction(1))})
    for n in range(0, 1001, 7):
        given = [mixture.given("a", 100, n), mixture.given(None, 300, n), mixture.given("b", 450, n), mixture.given("c", 150, n)]
        assert n - 4 < sum(given) <= n
        assert given[0] == min(100, n // 2) and (n >= 400 or given[2] == 0)
    assert [mixture.given(s, x, 1000) for s, x in (("a", 100), (None, 300), ("b", 450), ("c", 150))] == [100, 300, 450, 150]
    for source, size in (("a", 100), ("b", 450), ("c", 150)):
        for start in range(0, size, 13):
            pieces = list(mixture.blocks(source, size, start, min(29, size - start), 64))
            assert sum(p[2] for p in pieces) == min(29, size - start) and pieces[0][1] == start
            for block, a, n in pieces:
                assert mixture.given(source, size, block * 64) <= a and a + n <= mixture.given(source, size, min(1000, (block + 1) * 64))


def test_deficit_round_robin_serves_all():
    rng = np.random.default_rng(3)
    for _ in range(50):
        supplies = rng.integers(1, 5000, rng.integers(1, 30)).tolist()
        total = sum(supplies)
        first = int(rng.integers(1, 257))
        rooms = [r for r in [min(first, total), *[256] * (max(0, total - first) // 256), max(0, total - first) % 256] if r]
        plan = served(supplies, rooms, 32)
        assert plan.sum(axis=0).tolist() == supplies and plan.sum(axis=1).tolist() == rooms and (plan >= 0).all()


def test_sequences_are_the_ids(spark, documents, edges, tokenizer):
    rows = [(k, t, "en", s) for (k, t), s in zip(enumerate([e[1] for e in edges]), "aab" * 9, strict=False)]
    got = {r.sequence_id: r for r in sequences(documents(*rows), TOKENIZER, size=64, windows=2, quantum=8).collect()}
    texts = {k: _ids(tokenizer, t) for k, t, _, _ in rows}
    assert sorted(got) == list(range(len(got))) and all(len(r.ids) == 128 for n, r in got.items() if n < len(got) - 1)
    for r in got.values():
        ids = np.frombuffer(r.ids, "<u2").tolist()
        for p in r.pieces:
            assert ids[p.offset : p.offset + p.length] == texts[p.doc_id][p.start : p.start + p.length]


def test_nulls_empty_and_long_texts_repeated_rows_and_clashing_names(spark, documents, edges, tokenizer):
    docs = documents(*edges)
    for name in ("part", "row", "at", "n", "ids", "block", "size", "base", "p", "s", "sequence_id", "offset"):
        docs = docs.withColumn(name, F.lit("x"))
    rows = packed(docs, TOKENIZER).collect()
    expected = sum(len(_ids(tokenizer, t)) for _, t in edges)
    assert sum(r.length for r in rows) == expected
    assert sorted(((r.sequence_id, r.offset, r.length) for r in rows))[0][:2] == (0, 0)
    assert len({r.sequence_id for r in rows}) == -(-expected // 1024)
    assert packed(docs.limit(0), TOKENIZER).count() == 0


def test_reruns_agree(spark, documents):
    docs = documents(*((i, "some words here " * (i % 9), "en", f"s{i % 4}") for i in range(200))).repartition(3)
    first, second = (sorted(map(tuple, packed(docs, TOKENIZER, size=64, windows=4).collect())) for _ in range(2))
    assert first == second
    assert mixture_packing.QUANTUM < mixture_packing.SIZE

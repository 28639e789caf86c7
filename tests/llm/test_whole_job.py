"""Cases of the second review: inputs on which an operator once did less than the whole job."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from eventlake.llm import frames, mixing, packing, robust_quality, secret_links
from eventlake.llm.queries import TOKENIZER
from eventlake.llm.tokens import encoder

# quality


def _statistics(spark, *sources):
    """Counts of base-passing texts, good or full of symbols: (lang, source, good, bad) each."""
    rng, rows = np.random.default_rng(7), []
    for lang, source, good, bad in sources:
        for i in range(good + bad):
            n = int(np.exp(rng.normal(6, 0.5))) + 50
            rows.append((lang, source, n, n * 5 + int(rng.integers(0, n)), n if i < bad else 0, 0, 0, 10))
    return spark.createDataFrame(rows, "lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")


def _rejects_the_bad(spark, *sources):
    stats = _statistics(spark, *sources)
    judged = robust_quality.judged(stats, *robust_quality.fit(stats)).collect()
    assert all(r.distance is not None and r.kept == (r.n_symbols == 0) for r in judged)


def test_a_small_source_beside_large_ones_is_judged_by_its_language(spark):
    _rejects_the_bad(spark, ("en", "large", 300, 0), ("en", "new", 0, 40))


def test_a_rare_language_and_a_small_table_are_judged_by_the_whole_table(spark):
    _rejects_the_bad(spark, ("en", "large", 300, 0), (None, "new", 3, 9))
    _rejects_the_bad(spark, ("en", "a", 50, 3), ("de", None, 20, 2))


# tokens


WITH_ADDED = ["x<|endoftext|>y", "<|endoftext|>", "<|endoftext|><|endoftext|> a", "a <|endoftext|>\n b  c <|endoftext|>", "  <|endoftext|>  ", "<|endoftext|", "plain text", ""]


def test_added_tokens_are_found_as_the_loaded_tokenizer_finds_them(documents, tmp_path):
    loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [loaded.encode(t, add_special_tokens=False).ids for t in WITH_ADDED]
    assert ids[0] == [87, 50256, 88]
    assert [np.frombuffer(x, np.uint16).tolist() for x in encoder(TOKENIZER).tokenized(WITH_ADDED)] == ids

    docs = documents(*enumerate(WITH_ADDED))
    expected = {k: (len(x) + 1, lambda end, x=x: zlib.crc32(np.array([*x, end], "<u4").tobytes())) for k, x in enumerate(ids)}
    packed = packing.packed(docs, TOKENIZER).collect()
    assert {r.doc_id: (r.length, r.ids_crc32) for r in packed} == {k: (n, crc(2)) for k, (n, crc) in expected.items()}
    framed = frames.round_trip(docs, str(tmp_path), TOKENIZER).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in framed} == {k: (n, crc(0)) for k, (n, crc) in expected.items()}


# secrets


def test_long_spans_meet_identifiers_and_endpoints(documents):
    identifier, endpoint, long = "ASIA1234567890ABCDEF", "https://store.example.com/bucket", "aB3x" * 400
    texts = [f"token={long} {identifier} {endpoint}", "0a" * 900 + f" {identifier}", f"{identifier} {'aB3/' * 22} {endpoint}", f"token={long} {'. ' * 300}{identifier}", f"{identifier} token={long} {endpoint}"]
    got = {r.doc_id: [x.split(":")[0] for x in r.spans.split(",")] for r in secret_links.scan(documents(*enumerate(texts))).collect()}
    assert got == {0: ["assign", "identifier", "endpoint"], 1: ["hex", "identifier"], 2: ["identifier", "secret", "endpoint"], 3: ["assign"], 4: ["identifier", "assign", "endpoint"]}


# mixing


def test_a_long_document_does_not_end_a_pass(spark):
    rows = [(1, 300_000, "a", 1 << 35), *((i, 100, "a", i << 37) for i in range(2, 1_000)), (2_000, 400_000, "b", 5)]
    placed = spark.createDataFrame(rows, "doc_id long, size long, source string, u long")
    sources = mixing.plan(placed, weights=(1, 9), block_words=1_000).cache()
    taken, target = defaultdict(int), {}
    for r in mixing.drawn(placed, sources, mixing.shards(sources)).where("shard is not null").collect():
        taken[r.source] += r["size"]
        target[r.source] = r.target
    assert abs(target["a"] - 79_980) < 1 and abs(taken["a"] - target["a"]) <= 50


def test_time_grows_with_the_spans_and_not_with_their_square(documents):
    """A text of 40,000 hashes, and one of 8,000 identifiers, scopes and hashes, within seconds."""
    import time

    hashes = "".join(f"{i:024x}\n" for i in range(40_000))
    parts = "".join(f"ASIA12345678{i:08d} token=abcdef{i}\n \n" for i in range(8_000))
    start = time.perf_counter()
    got = {r.doc_id: r for r in secret_links.scan(documents((1, hashes), (2, parts))).collect()}
    taken = time.perf_counter() - start
    assert got[1].n_hex == 40_000 and got[1].spans.endswith("hex:999975:999999")
    assert got[2].n_assign == 8_000 and got[2].n_linked == 8_000 and got[2].spans.count("identifier") == 8_000
    assert taken < 60


def test_planted_credentials_are_found(documents):
    """Identifiers beside secrets, planted in prose at known places; the same parts alone, or far apart, are not reported."""
    rng = np.random.default_rng(5)
    upper, mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789"
    prose = lambda n: " ".join(rng.choice(["the", "river", "keeps", "its", "old", "name"], n))

    def identifier():
        return "K7" + "".join(rng.choice(list(upper), 18))

    def secret():
        return "aB3" + "".join(rng.choice(list(mixed), 37))

    planted, rows = {}, []
    for i in range(200):
        a, b, near = identifier(), secret(), i % 2 == 0
        between = prose(int(rng.integers(1, 60))) if near else prose(300)
        text = f"{prose(20)} {a} {between} {b} {prose(20)}" if i % 4 else f"{prose(5)} {b}\n{between if near else prose(300)} {a} {prose(9)}"
        rows.append((i, text))
        planted[i] = {text.index(a), text.index(b)} if near else set()
    rows += [(900 + i, f"{prose(30)} {identifier() if i % 2 else secret()} {prose(30)}") for i in range(50)]
    got = {r.doc_id: {int(s.split(":")[1]) for s in r.spans.split(",") if s} for r in secret_links.scan(documents(*rows)).collect()}
    found = sum(len(planted[i] & got[i]) for i in planted)
    wanted = sum(map(len, planted.values()))
    assert found / wanted >= 0.9 and not any(got[k] for k in got if not planted.get(k))


# frames


def test_files_are_bounded_and_read_by_many_tasks(documents, tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "READ_IDS", 100)
    docs = documents(*((i, "some words " * (i % 5)) for i in range(100)))
    files = frames.write(docs.coalesce(1), str(tmp_path), TOKENIZER, file_docs=8)
    assert files.count() >= 13 and files.where("docs > 8").isEmpty()
    back = frames.read(files)
    assert back.rdd.getNumPartitions() >= 4
    rows = sorted(back.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == list(range(100))
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]

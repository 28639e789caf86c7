"""Each operator on documents against a brute-force version, and on edge cases."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventlake.llm import common, frames, golomb_dedup, mixing, ngram_join, packing, robust_quality, secret_links
from eventlake.llm.queries import TOKENIZER
from eventlake.llm.tokens import encoder

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# exact duplicates


def test_golomb_code_round_trips():
    rng = np.random.default_rng(1)
    for values in (rng.integers(0, 1 << 60, 500, np.uint64), np.arange(9, dtype=np.uint64), np.array([0], np.uint64), np.array([3, 1 << 63], np.uint64)):
        values = np.unique(values)
        width, code = golomb_dedup.golomb_encode(values)
        assert (golomb_dedup.golomb_decode(len(values), width, code) == values).all()


def _exact(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    out = []
    for text, keys in groups.items():
        keep = max(keys, key=lambda k: (k is not None, k))
        for n, key in enumerate(sorted(keys, key=lambda k: (k is not None, k))):
            out.append((key, keep, len(keys), n == len(keys) - 1, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def test_exact_duplicates_match_brute_force(run, sample):
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in run("op10_golomb_dedup"))
    assert got == _exact(sample("documents", "doc_id", "text"))


def test_exact_duplicates_edges(documents, edges):
    rows = golomb_dedup.exact_duplicates(documents(*edges)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows) == _exact(edges)
    assert golomb_dedup.exact_duplicates(documents(*edges).limit(0)).count() == 0


def test_without_copies_keeps_columns_and_one_row_of_each(documents, edges):
    docs = documents(*edges).withColumn("fp", F.lit("mine")).withColumn("row", F.lit(1)).withColumn("block", F.lit(2))
    kept = golomb_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(2, ""), (3, " \n\t"), (5, "one"), (6, "word " * 40_000)])


# near duplicates


def _shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORDS.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _near(rows):
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
            links += a != b
            root[find(j)] = find(i)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        least[find(i)].append(key)
    name = {r: min((k for k in keys if k is not None), default=None) for r, keys in least.items()}
    return Counter((key, len(sets[i]), name[find(i)]) for i, (key, _) in enumerate(rows)), links


def _rows(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_near_duplicates_match_brute_force(run, sample):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in run("op2_ngram_jaccard_join"))
    assert got == _near(sample("documents", "doc_id", "text"))[0]


def _variants(count, seed=0):
    """Families of texts around the threshold, with a passage that all share."""
    rng = np.random.default_rng(seed)
    common_words = [f"c{i}" for i in range(60)]
    rows, key = [], 0
    for family in range(6):
        base = [f"w{family}x{i}" for i in rng.integers(0, 400, 150)]
        for _ in range(count):
            words = list(base)
            for _ in range(rng.integers(0, 6)):
                words[rng.integers(0, len(words))] = f"e{rng.integers(0, 9)}"
            at = rng.integers(0, len(words))
            rows.append((key, " ".join([*words[:at], *common_words, *words[at:]] if family % 2 else words)))
            key += 1
    return rows


def test_near_duplicates_of_families(documents):
    rows = _variants(25)
    assert _rows(ngram_join.near_duplicates(documents(*rows))) == _near(rows)[0]


def test_links_are_all_pairs_of_different_sets(documents):
    rows = _variants(8, seed=3)
    found, members = ngram_join.links(documents(*rows))
    distinct = {frozenset(_shingles(t)): (k, t) for k, t in rows}
    assert found.count() == _near(list(distinct.values()))[1]
    assert members.count() == len(rows)


def test_near_duplicates_edges(documents, edges):
    rows = [*edges, (7, "A b c d"), (8, "a B c d"), (9, "a b c d e"), (10, "\u00c4 b c d"), (11, "\u00e4 b c d"), (12, "a\u00a0b c d")]
    assert _rows(ngram_join.near_duplicates(documents(*rows))) == _near(rows)[0]
    assert ngram_join.near_duplicates(documents(*rows).limit(0)).count() == 0


def test_one_of_each_keeps_the_smallest(documents):
    rows = [*_variants(6), (None, "x"), (1000, None)]
    docs = documents(*rows).withColumn("set_id", F.lit("mine")).withColumn("gone", F.lit(True))
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    expected = {key for key, _, root in _near(rows)[0] if key == root or key is None}
    assert {r.doc_id for r in kept.collect()} == expected


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(10, 60)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {7, 100} and len(got) == 61 + 51


# quality


def _counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))  # noqa: B905
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def test_base_counts_match_brute_force(run, sample):
    texts = dict(sample("documents", "doc_id", "text"))
    for r in run("op1_robust_outliers"):
        n, *_, repeated = expected = _counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.base_failed and r.kept)


def _reference_mcd(x):
    """Concentration steps from many random subsets: the lowest determinant is the estimate's yardstick."""
    rng, best = np.random.default_rng(0), None
    floors = np.diag([f**2 for _, f in robust_quality.VECTOR.values()])
    h = (len(x) + 1) // 2
    for _ in range(40):
        part = x[rng.choice(len(x), 12, replace=False)]
        for _ in range(15):
            mean, scatter = part.mean(0), np.cov(part.T, bias=True) + floors
            part = x[np.argsort(np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(scatter), x - mean))[:h]]
        det = np.linalg.slogdet(np.cov(part.T, bias=True) + floors)[1]
        if best is None or det < best[0]:
            best = det, part.mean(0)
    return best


def test_estimates_match_a_search_from_many_starts(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        n = int(np.exp(rng.normal(6, 0.5)))
        bad = i % 5 == 0
        rows.append(("en", "s", n, n * (9 if bad else 5) + int(rng.integers(0, n)), n if bad else int(rng.integers(0, 3)), 0, 0, 10))
    stats = spark.createDataFrame(rows, "lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")
    groups, estimates = robust_quality.fit(stats)
    judged = robust_quality.judged(stats, groups, estimates).collect()
    assert {r.kept for r in judged if r.n_symbols == r.n_words} == {False}
    assert {r.kept for r in judged if r.n_symbols != r.n_words} == {True}
    x = np.array([[float(r[f"x{i}"]) for i in range(robust_quality.P)] for r in stats.select(*robust_quality._vector()).collect()]) / robust_quality.STEP
    centre = np.array(estimates.first()["centre"])
    assert np.abs(centre - _reference_mcd(x)[1]).max() < 0.15


def test_quality_edges(documents, edges):
    rows = [*edges, *((100 + i, " ".join(f"w{i * j % 97}x{j}" for j in range(80)), None, None) for i in range(150))]
    got = robust_quality.quality(documents(*rows)).collect()
    assert len(got) == len(rows)
    assert all(r.base_failed and not r.kept for r in got if r.doc_id is None or r.doc_id < 100)
    assert sum(r.kept for r in got if (r.doc_id or 0) >= 100) >= 148
    docs = documents(*rows).withColumn("counts", F.lit("mine")).withColumn("lang_", F.lit(1))
    kept = robust_quality.without_outliers(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert robust_quality.quality(docs.limit(0)).count() == 0


# tokens, packing, frames


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(library, sample):
    texts = [t for _, t in sample("documents", "doc_id", "text")]
    texts += ["", " ", "  ", "   a   b ", "a  b\n\n c \t d", "<|endoftext|> x", "don't we'll \u00a0 x\u2003y", "\x00 a\x00  b", "\n a \n  b", "\x1c a \x1c b", "\U0001f600 \u4e00\u4e8c  \u00b2", " \x85x  \u3000 y", "a's 't '' it's_x !! '\u00e9", "x_y ,. \u00aa\u00b5 \u00f7\u00d7 \u01c5\u0250"]
    got = [np.frombuffer(x, np.uint16).tolist() for x in encoder(TOKENIZER).encode(texts)]
    assert got == [library(t) for t in texts]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def _check_packing(got, rows, library):
    by_piece, sequences = defaultdict(Counter), defaultdict(list)
    for r in got:
        by_piece[r.doc_id][(r.piece, r.start, r.length, r.ids_crc32)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(Counter)
    total, over_half = 0, 0
    for key, text in rows:
        ids = [*library(text), 2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        total, over_half = total + len(ids), over_half + sum(b - a > 512 for a, b in itertools.pairwise(cuts))
        for n, (a, b) in enumerate(itertools.pairwise(cuts)):
            expected[key][(n, a, b - a, _crc(ids[a:b]))] += 1
    assert by_piece == expected
    for placed in sequences.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:i]) for i in range(len(placed))]
        assert sum(n for _, n in placed) <= 1024
    return len(sequences), max(-(-total // 1024), over_half)


def test_packing_matches_brute_force(run, sample, library):
    used, least = _check_packing(run("op4_certified_packing"), sample("documents", "doc_id", "text"), library)
    assert used <= least * 1.01 + 1


def test_packing_edges(documents, edges, library):
    _check_packing(packing.packed(documents(*edges), TOKENIZER).collect(), edges, library)
    assert packing.packed(documents(*edges).limit(0), TOKENIZER).count() == 0


def test_exchange_saves_sequences(spark):
    lengths = [513, 511] * 60 + [700, 324] * 60 + [600] * 10
    rows = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    alone = packing.pack(rows, partition_rows=20, rounds=0).select("sequence_id").distinct().count()
    with_exchange = packing.pack(rows, partition_rows=20).collect()
    assert len({r.sequence_id for r in with_exchange}) < alone
    assert len(with_exchange) == len(lengths)


def test_bounds_and_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = np.sort(rng.integers(1, 60, 40))[::-1]
        where, offset, bins = packing.best_fit(lengths, 60)
        bound = packing.lower_bound(lengths, 60)
        assert -(-int(lengths.sum()) // 60) <= bound <= bins <= bound * 1.3 + 1
        assert all(np.bincount(where, lengths) <= 60) and len(set(zip(where, offset, strict=True))) == len(lengths)
    assert packing.lower_bound(np.array([31] * 10), 60) == 10
    assert packing.lower_bound(np.array([21] * 10), 60) == 5


def test_sequences_hold_the_ids(documents, library):
    rows = [(1, "a b c"), (2, "x " * 2000), (2, "y " * 700), (None, None)]
    got = packing.sequences(documents(*rows), TOKENIZER).collect()
    everything = Counter()
    for r in got:
        ids = np.frombuffer(r.ids, np.uint16).tolist()
        assert len(ids) == sum(p["length"] for p in r.pieces) <= 1024
        everything.update(ids)
    assert everything == Counter(i for _, t in rows for i in [*library(t), 2])


def _check_frames(got, rows, library):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expected = 0, Counter()
    for key, text in order:
        ids = [*library(text), 0]
        expected[(key, start, len(ids), _crc(ids))] += 1
        start += len(ids)
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected


def test_frames_match_brute_force(run, sample, library):
    _check_frames(run("op6_seekable_frames"), sample("documents", "doc_id", "text"), library)


def test_frames_edges(documents, edges, library, tmp_path):
    _check_frames(frames.round_trip(documents(*edges), str(tmp_path), TOKENIZER).collect(), edges, library)
    assert frames.round_trip(documents(*edges).limit(0), str(tmp_path), TOKENIZER).count() == 0


def test_a_frame_is_read_alone_and_checked(tmp_path):
    import zstandard

    path = str(tmp_path / "x.zst")
    writer = frames.Writer(path)
    for i in range(20):
        writer.add(i * 3 if i else None, np.arange(i * 7))
    writer.close()
    reader = frames.Reader(path)
    assert reader.keys == [None, *(i * 3 for i in range(1, 20))]
    assert reader.ids(13).tolist() == list(range(91))
    whole = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"), read_across_frames=True).read()
    assert len(whole) == 2 * sum(i * 7 for i in range(20))
    raw = bytearray(open(path, "rb").read())
    raw[int(reader.starts[5]) + 12] ^= 1
    open(path, "wb").write(raw)
    assert frames.Reader(path).ids(13).tolist() == list(range(91))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        frames.Reader(path).ids(5)


# mixing


def _check_mix(got, rows):
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(WORDS.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, excess = {}, list(order), float(sum(sizes.values()))
    while free:
        share = {s: excess * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            excess -= target[s]
            free.remove(s)
    taken, longest = defaultdict(int), defaultdict(int)
    by_row = Counter((r.doc_id, r.size) for r in got)
    assert by_row == Counter((k, len(WORDS.findall(t or ""))) for k, t, *_ in rows)
    source_of = {k: s for k, _, _, s in rows}
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * len(r.shards)
        taken[s] += r.taken
        longest[s] = max(longest[s], r.size)
    for s in order:
        assert abs(taken[s] - target[s]) <= max(1, longest[s] / 2)
    return taken, target


def test_mixing_matches_brute_force(run, sample):
    _check_mix(run("op5_hypergeometric_mixing"), sample("documents", "doc_id", "text", "lang", "source"))


def test_mix_is_close_where_sources_have_some_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    taken, target = _check_mix(mixing.mixed(docs).collect(), docs.select("doc_id", "text", "lang", "source").collect())
    assert sum(abs(taken[s] - target[s]) for s in taken) < 0.005 * sum(target.values())


def test_mixing_edges(documents):
    rows = [(i, "w " * (i % 9), "en", [None, "", "a", "b", "c\u00e9", "big"][i % 6 if i < 60 else 5]) for i in range(200)] + [(1000, None, None, "empty"), (1001, "", None, "empty")]
    rows = [(k, t, l, s) for k, t, l, s in rows]
    docs = documents(*rows)
    _check_mix(mixing.mixed(docs).collect(), rows)
    first, second = (sorted(map(tuple, mixing.mixed(docs.repartition(n)).select("doc_id", "taken").collect())) for n in (1, 7))
    assert first == second
    assert mixing.mixed(docs.limit(0)).count() == 0
    assert mixing.mixed(docs.where("source = 'empty'")).count() == 2


def test_mixture_returns_the_rows_that_are_drawn(documents):
    rows = [(i, f"{i} " + "w " * (i % 9), "en", "abc"[i % 3]) for i in range(90)]
    docs = documents(*rows).withColumn("u", F.lit("mine")).withColumn("shard", F.lit(0)).withColumn("row", F.lit(1))
    mix = mixing.mixture(docs)
    assert mix.columns == docs.columns
    got = Counter(r.doc_id for r in mix.collect())
    assert got == Counter({r.doc_id: len(r.shards) for r in mixing.mixed(docs).collect() if r.shards})


def test_splitting_tree_is_exact_and_hypergeometric(spark):
    sources = spark.createDataFrame([(i, "s", q, float(q) * 100, q) for i, q in enumerate((40, 0, 7, 1, 300))], "number long, source string, source_size long, target double, quota long").cache()
    draws = []
    for seed in range(12):
        blocks = mixing.shards(sources, shard_words=9000, seed=seed * 1000).collect()
        assert Counter(b.number for b in blocks) == {0: 40, 2: 7, 3: 1, 4: 300}
        assert len({(b.number, b.copy) for b in blocks}) == 348
        per = Counter(b.shard for b in blocks)
        assert set(per) == {0, 1, 2, 3} and set(per.values()) == {87}
        draws += [sum(b.number == 0 and b.shard == s for b in blocks) for s in range(4)]
    assert abs(np.mean(draws) - 10) < 1e-9
    assert 3 < np.var(draws) < 12  # hypergeometric: 10 * (1 - 40 / 348) * (348 - 87) / 347 = 6.7


# secrets


PATTERNS = [r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", r"AKIA[A-Z0-9]+", r"[0-9a-f]+"]


def _base(text):
    found = []
    for rank, (kind, pattern) in enumerate(zip(("assign", "access", "hex"), PATTERNS, strict=True)):
        for m in re.finditer(pattern, text or "", re.IGNORECASE | re.ASCII if kind == "assign" else 0):
            if len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24):
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def _check_secrets(got, rows):
    expected = Counter()
    for key, text in rows:
        found = _base(text)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in found).encode()).hexdigest()
        expected[(key, *(sum(k == kind for *_, k in found) for kind in ("assign", "access", "hex")), digest)] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == expected


def test_base_spans_match_brute_force(run, sample):
    _check_secrets(run("op3_credential_linking"), sample("documents", "doc_id", "text"))


TRICKY = [
    "secret: token: abcdefgh", "token=token=abcdefgh", "\u00e4\U0001f600 API_KEY = 'abc_def-1' apikey:x", "AKIAAKIA" + "A" * 16 + " AKIA" + "9" * 15, "f" * 24 + "g" + "0" * 23,
    "passwordpassword=123456", "Token:: abcdef", 'token" = "abc.de=f"', "toKen\u2003= abcdef", "tok\u212aen=abcdef", "\u017fecret=abcdef", "secret  \n= abcdef", "hex " + "ab" * 12 + " " + "ab" * 12, "password=" + "x" * 100_000,
]


def test_base_spans_edges(documents, edges):
    rows = [*edges, *enumerate(TRICKY, 100)]
    _check_secrets(secret_links.scan(documents(*rows)).collect(), rows)
    assert secret_links.scan(documents(*rows).limit(0)).count() == 0


def test_weak_parts_are_reported_only_together(documents):
    identifier, secret, endpoint = "ASIA1234567890ABCDEF", "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY12", "https://store.example.com/bucket"
    texts = [identifier, secret, f"{endpoint} {identifier}", f"{endpoint} {secret}", f"{identifier} {secret}", f"{identifier}\n{secret} {endpoint}", f"{identifier}\n \n{secret}", identifier + " x" * 400 + " " + secret, f"AKIA{'A1' * 8} {secret}", f"{identifier} token = abcdef"]
    got = {r.doc_id: r.spans for r in secret_links.scan(documents(*enumerate(texts))).collect()}
    kinds = [[s.split(":")[0] for s in got[i].split(",") if s] for i in range(len(texts))]
    assert kinds == [[], [], [], [], ["identifier", "secret"], ["identifier", "secret", "endpoint"], [], [], ["access", "secret"], ["identifier", "assign"]]
    start, end = (int(x) for x in got[4].split(",")[1].split(":")[1:])
    assert texts[4][start:end] == secret

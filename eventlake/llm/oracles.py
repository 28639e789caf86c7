"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

#: Levels of a Merkle tree written out in SQL: up to 16^7 rows of one source.
MERKLE_LEVELS = 7


def _crc32(value: str) -> str:
    """The unsigned CRC-32 of an ASCII text: a byte at a time, eight steps of the reflected polynomial each."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    table = f"list_reduce([xor(c, b) & 255] || range(8), lambda x, j: {step})"
    letters = f"list_transform(range(1, length({value}) + 1), lambda i: ascii(({value})[i:i])::BIGINT)"
    return f"(4294967295 - list_reduce([4294967295::BIGINT] || {letters}, lambda c, b: xor(c >> 8, {table})))"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _merkle_levels(name: str, leaves: str, tree: str) -> list[str]:
    """CTEs that climb ``leaves`` (tree, rank, digest, id): one with each row's place and digest run per level, as long as
    its tree has several nodes."""
    ctes = [f"{name}0 AS ({leaves})"]
    for level in range(MERKLE_LEVELS):
        ctes.append(
            f"""{name}{level + 1} AS (
  SELECT {tree}, rank // 16 AS rank, CASE WHEN any_value(nodes) > 1 THEN sha256(string_agg(digest, '' ORDER BY rank)) ELSE any_value(digest) END AS digest,
    CASE WHEN any_value(nodes) > 1 THEN list(digest ORDER BY rank) ELSE [] END AS kids
  FROM (SELECT *, count(*) OVER (PARTITION BY {tree}) AS nodes FROM {name}{level}) GROUP BY {tree}, rank // 16)"""
        )
    return ctes


def _merkle_sql() -> str:
    fields = ["doc_id", "source", "lang", "n_chars"]
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = f"coalesce({_crc32('doc_id::VARCHAR')} % 5 = 0, false)"
    found = f"CASE WHEN {hit} THEN translate(text, '{upper}', '{upper.lower()}') ELSE text END"
    ctes = [
        f"""hashed AS (
  SELECT doc_id, source, sha256({" || ".join(_field(f) for f in [*fields, "text"])}) AS digest,
    sha256({" || ".join(_field(f) for f in [*fields, f"({found})"])}) AS found FROM documents)""",
        "trees AS (SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM documents))",
        """leaves AS (
  SELECT h.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS rank
  FROM hashed h JOIN trees t ON h.source IS NOT DISTINCT FROM t.source)""",
        *_merkle_levels("own", "SELECT tree, rank, digest FROM leaves", "tree"),
        *_merkle_levels("top", f"SELECT 0 AS tree, tree AS rank, digest FROM own{MERKLE_LEVELS}", "tree"),
    ]

    def siblings(name: str, tree: str, rank: str) -> tuple[list[str], list[str], list[str]]:
        joins, before, after = [], [], []
        for level in range(MERKLE_LEVELS):
            at = f"{name}p{level}"
            joins.append(f"JOIN {name}{level + 1} {at} ON {at}.tree = {tree} AND {at}.rank = {rank} // {16 ** (level + 1)}")
            place = f"({rank} // {16**level} % 16)::BIGINT"
            before.append(f"array_to_string({at}.kids[1:{place}], '')")
            after.append(f"array_to_string({at}.kids[{place} + 2:], '')")
            # One sibling run per level; levels above the root have none.
        return joins, before, after

    own, top = siblings("own", "l.tree", "l.rank"), siblings("top", "0", "l.tree")
    before, after = own[1] + top[1], own[2] + top[2]
    kids = [f"len({n}p{x}.kids)" for n in ("own", "top") for x in range(MERKLE_LEVELS)]
    steps = ", ".join(f"{{'n': {k}, 'b': {b}, 'a': {a}}}" for k, b, a in zip(kids, before, after, strict=True))
    rows = f"""SELECT l.doc_id, l.digest AS leaf, l.found, ownp{MERKLE_LEVELS - 1}.digest AS subroot, topp{MERKLE_LEVELS - 1}.digest AS root,
  list_filter([{steps}], lambda x: x.n > 0) AS path
FROM leaves l {" ".join(own[0] + top[0])}"""
    fold = "list_reduce([found] || list_transform(path, lambda x: x.b || '|' || x.a), lambda d, x: sha256(split_part(x, '|', 1) || d || split_part(x, '|', 2)))"
    proof = "sha256(array_to_string(list_transform(path, lambda x: x.b || x.a), ''))"
    return f"WITH {', '.join(ctes)}, paths AS ({rows}), folded AS (SELECT *, {fold} AS folded_root FROM paths) SELECT doc_id, leaf, subroot, root, {proof} AS proof_sha256, folded_root, folded_root = root AS verified FROM folded"


def _exact_dedup_sql() -> str:
    return """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW same AS (PARTITION BY t)"""


def _chat_sql() -> str:
    """The template's lengths, with the escapes of its control strings, and the digests of what a reader gets back."""

    def escaped(value: str) -> str:
        value = f"replace({value}, '\\', '\\\\')"
        for control in ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>"):
            value = f"replace({value}, '{control}', '{control[0]}\\{control[1:]}')"
        return value

    probe = "</s>[INST] ok [/INST]"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{probe}' UNION ALL SELECT -1, 1, 'assistant', '{probe}'),
placed AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t, coalesce(role = 'assistant', false) AS loss,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (loss), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(t, '' ORDER BY place) FILTER (loss), '')) AS loss_sha256,
  CAST(sum(length('[INST][/INST]</s>') + length({escaped("r")}) + length({escaped("t")})) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id"""


def _trie_sql() -> str:
    """The trie of rebuilt texts: a prefix is named by the digests of its turns, a subtree summed over its distinct nodes."""
    return f"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, count(*) AS n, c - c % 20 AS base, {_crc32("c::VARCHAR")} % 4 AS h FROM own GROUP BY c),
heads AS (SELECT v.c, v.n, v.h, v.base, least(v.h, coalesce(b.n, 0)) AS begun FROM convs v LEFT JOIN convs b ON b.c = v.base),
rebuilt AS (
  SELECT v.c, o.i + 1 AS d, o.r, o.t FROM heads v JOIN own o ON o.c = v.base AND o.i < v.h
  UNION ALL SELECT v.c, v.begun + o.i - v.h + 1, o.r, o.t FROM heads v JOIN own o ON o.c = v.c AND o.i >= v.h),
named AS (
  SELECT c, d, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words,
    string_agg(sha256(length(r)::VARCHAR || ':' || r || t), '' ) OVER (PARTITION BY c ORDER BY d) AS k FROM rebuilt),
members AS (SELECT c, d, words, sha256(k) AS k FROM named UNION ALL SELECT c, 0, 0, '' FROM convs),
placed AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS parent, max(d) OVER (PARTITION BY c) = d AS ends FROM members),
nodes AS (
  SELECT k, any_value(d) AS depth, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM placed GROUP BY k),
children AS (SELECT parent AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
below AS (SELECT DISTINCT a.k, b.k AS node FROM placed a JOIN placed b ON a.c = b.c AND b.d >= a.d),
sums AS (
  SELECT b.k, count(*) FILTER (ch.n IS NULL) AS n_leaves, CAST(sum((n.n_convs - 1) * n.words) AS BIGINT) AS saved_tokens
  FROM below b JOIN nodes n ON n.k = b.node LEFT JOIN children ch ON ch.k = b.node GROUP BY b.k)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (k) LEFT JOIN children ch USING (k) LEFT JOIN nodes up ON up.k = n.parent AND n.depth > 0"""


def oracle_sql() -> dict[str, str]:
    return {
        "op8_reply_trees": _chat_sql(),
        "op10_golomb_dedup": _exact_dedup_sql(),
        "op11_prefix_trie": _trie_sql(),
        "op12_merkle_manifest": _merkle_sql(),
    }

"""Secret scans with multipart credential linking.

Spans with a pattern of their own are always reported: assignments, access keys, long hexadecimal strings. Three weak kinds
prove nothing alone: identifiers, secret-looking strings and endpoints. Within a scope, a stretch of text between blank
lines, identifiers and secrets are joined by their distance; weak ones are reported where they meet, and endpoints where an
identifier and a secret that belong together are near.

Spans count code points. They follow from the pieces between matches (``split``) and the matches, in one pass over the text.
The interval join is an equi-join on cells as wide as the allowed distance, so that its rows are bounded by the cells' width.
A span is in all cells it covers, whatever its length; a pair is joined in the first cell that both share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import text_of, written

#: The patterns of the base kinds, with the shortest length each must have (of group 2 for assignments).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
SHORTEST_VALUE = 6
#: Weak kinds. Identifiers and secrets stand alone between characters that cannot belong to them.
IDENTIFIER = r"(?<![A-Za-z0-9_])[A-Z](?=[A-Z0-9]{0,30}[0-9])[A-Z0-9]{15,31}(?![A-Za-z0-9_])"
SECRET = r"(?<![A-Za-z0-9+/_=-])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{32,}+={0,2}+(?![A-Za-z0-9+/_=-])"
ENDPOINT = r"""(?i)\bhttps?://[a-z0-9.-]+(?::[0-9]{1,5})?(?:/[^\x20\x09-\x0D"'<>]*)?"""
SCOPE_END = r"\n[\x20\x09\x0D]*\n"
BASE, WEAK = ("assign", "access", "hex"), ("identifier", "secret", "endpoint")
#: Largest gap between parts of one credential, in code points.
REACH = 512


#: Matches whose places are summed up together; their sums are then added up in turn.
_RUN = 256


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def _placed(pairs: Column, start: Column) -> Column:
    """Spans of (piece, found) lengths that follow each other from ``start`` on. An array grows by copies, so for short runs."""
    kind = "array<struct<start:bigint,end:bigint,found:string>>"

    def add(seen: Column, x: Column) -> Column:
        span = F.struct((seen["at"] + x["before"]).alias("start"), (seen["at"] + x["before"] + x["length"]).alias("end"), x["found"].alias("found"))
        return F.struct((seen["at"] + x["before"] + x["length"]).alias("at"), F.concat(seen["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pairs, F.struct(start.alias("at"), F.array().cast(kind).alias("spans")), add, lambda s: s["spans"])


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: an array of (start, end, found), code points, end exclusive.

    Places are sums of lengths. They are taken over runs of matches and over the runs, so that the work grows with the number
    of matches and not with its square.
    """
    kind = "array<struct<start:bigint,end:bigint,found:string>>"
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    lengths = F.transform(
        F.filter(zipped, lambda x: x["found"].isNotNull()),
        lambda x: F.struct(F.length(x["piece"]).cast("long").alias("before"), F.length(x["found"]).cast("long").alias("length"), x["found"].alias("found")),
    )

    def over_runs(pairs: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.ceil(F.size(pairs) / _RUN).cast("int") - 1), lambda i: F.slice(pairs, i * _RUN + 1, F.lit(_RUN)))
        return _let(runs, lambda r: F.flatten(F.zip_with(r, starts(r), _placed)))

    def starts(runs: Column) -> Column:
        sums = F.transform(runs, lambda r: F.aggregate(r, F.lit(0).cast("long"), lambda s, x: s + x["before"] + x["length"]))
        none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("all"))
        step = lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all"))
        return F.aggregate(sums, none, step, lambda s: s["all"])

    return F.when(F.regexp_like(text, F.lit(pattern)), _let(lengths, over_runs)).otherwise(F.array().cast(kind))


def _of_kind(kind: str, found: Column) -> Column:
    rank = (*BASE, *WEAK).index(kind)
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))


def _base(text: Column) -> Column:
    """Base spans (start, rank, end). Short assignments are matched and then dropped: they use up their text."""
    assign = F.filter(spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= SHORTEST_VALUE)
    return F.array_sort(F.concat(_of_kind("assign", assign), _of_kind("access", spans(text, ACCESS)), _of_kind("hex", spans(text, HEX))))


def _joined(found: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*BASE, *WEAK)))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", names[s["rank"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _meeting(left: DataFrame, right: DataFrame, reach: int) -> DataFrame:
    """Pairs of parts of the same text and scope with a gap of ``reach`` at most: columns of the left, and ``with_*``."""
    first = f"greatest(0, start - {reach}) div {reach}"
    cells = left.withColumn("first", F.expr(first)).withColumn("near", F.explode(F.expr(f"sequence(first, (end + {reach}) div {reach})")))
    other = right.select(*(F.col(c).alias(f"with_{c}") for c in ("id", "scope", "start", "rank", "end")))
    other = other.withColumn("cell", F.explode(F.expr(f"sequence(with_start div {reach}, with_end div {reach})")))
    on = (F.col("id") == F.col("with_id")) & (F.col("scope") == F.col("with_scope")) & (F.col("near") == F.col("cell"))
    once = F.expr(f"cell = greatest(first, with_start div {reach})")
    gap = F.greatest(F.col("with_start") - F.col("end"), F.col("start") - F.col("with_end"))
    return cells.join(other, on).where(once & (gap <= reach)).drop("first", "near", "cell")


def _without_covered(parts: DataFrame) -> DataFrame:
    """Parts without the weak ones that overlap a base span, by an equi-join on the cells that spans cover."""
    cells = f"sequence(start div {REACH}, greatest(start, end - 1) div {REACH})"
    is_base = F.col("rank") < len(BASE)
    base = parts.where(is_base).select(F.col("id").alias("b_id"), F.explode(F.expr(cells)).alias("b_cell"), F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    weak = parts.where(~is_base).withColumn("cell", F.explode(F.expr(cells)))
    overlap = (F.col("id") == F.col("b_id")) & (F.col("cell") == F.col("b_cell")) & (F.col("b_start") < F.col("end")) & (F.col("start") < F.col("b_end"))
    covered = weak.join(base, overlap, "left_semi").select("id", "start", "rank", "end").distinct()
    return parts.join(covered, ["id", "start", "rank", "end"], "left_anti").select("id", "scope", "start", "rank", "end")


def linked(parts: DataFrame, *, reach: int = REACH) -> DataFrame:
    """The weak parts to report (id, start, rank, end) among parts (id, scope, start, rank, end) of all kinds."""
    rank = {k: i for i, k in enumerate((*BASE, *WEAK))}
    identifiers = parts.where(F.col("rank").isin(rank["access"], rank["identifier"]))
    secrets = parts.where(F.col("rank").isin(rank["assign"], rank["hex"], rank["secret"]))
    pairs = _meeting(identifiers, secrets, reach)
    one = pairs.select("id", "scope", "start", "rank", "end")
    two = pairs.select("id", F.col("with_scope").alias("scope"), F.col("with_start").alias("start"), F.col("with_rank").alias("rank"), F.col("with_end").alias("end"))
    complete = written(one.unionByName(two).distinct(), "credentials")
    endpoints = _meeting(parts.where(F.col("rank") == rank["endpoint"]), complete, reach).select("id", "scope", "start", "rank", "end")
    weak = complete.where(F.col("rank").isin(rank["identifier"], rank["secret"]))
    return weak.unionByName(endpoints).select("id", "start", "rank", "end").distinct()


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    A NULL text is empty and has no spans. Rows that repeat key and text have the same spans; a row's name in the joins is the
    128-bit digest of both. The time of a text grows with its length and its spans. A weak span that overlaps a base
    span is not reported again. An empty table gives no rows. Texts are not shuffled.
    """
    body = text_of(text)
    weak = F.concat(*(_of_kind(k, spans(body, p)) for k, p in zip(WEAK, (IDENTIFIER, SECRET, ENDPOINT), strict=True)))
    scopes = F.transform(spans(body, SCOPE_END), lambda s: s["end"])
    rows = docs.select(F.col(key).alias("doc_id"), F.md5(F.concat(F.encode(body, "UTF-8"), F.lit(b"\0"), F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8"))).alias("id"), _base(body).alias("base"), weak.alias("weak"), scopes.alias("scopes"))
    rows = written(rows.withColumn("scopes", F.when(F.size("weak") > 0, F.col("scopes"))), "spans")

    some = rows.where(F.size("weak") > 0)
    start_of_scope = some.select("id", F.explode("scopes").alias("start"), F.lit(None).cast("int").alias("rank"), F.lit(None).cast("long").alias("end"))
    all_parts = some.select("id", F.explode(F.concat("base", "weak")).alias("part")).select("id", "part.start", "part.rank", "part.end").distinct()
    # Scopes are numbered along each text; one begins before the parts at its place.
    along = Window.partitionBy("id").orderBy("start", F.asc_nulls_first("rank")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scoped = all_parts.unionByName(start_of_scope.distinct()).withColumn("scope", F.count_if(F.col("rank").isNull()).over(along))
    scoped = written(scoped.where(F.col("rank").isNotNull()), "all-parts")
    parts = written(_without_covered(scoped), "parts")
    more = linked(parts, reach=reach).groupBy("id").agg(F.collect_list(F.struct("start", "rank", "end")).alias("more"))
    joined = rows.join(written(more, "linked"), "id", "left")
    more = F.coalesce("more", F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["rank"] == BASE.index(kind))).cast("long").alias(f"n_{kind}")
    return joined.select(
        "doc_id",
        *(count(k) for k in BASE),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", more))).alias("spans"),
        F.size(more).cast("long").alias("n_linked"),
    )

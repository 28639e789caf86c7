"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

A source's documents are permuted by a hash and cut into blocks, ranges of the permutation. A source below its target is taken
whole as often as it fits; the rest is a prefix of its permutation, without documents longer than what is missing, continued
behind them until none fits, and one further document if it brings the source closer to the target. This gives each source an exact quota of blocks. A binary tree splits the quotas among output shards: at each node the
left half's number of blocks from each source is a hypergeometric draw, source after source, so that every shard is a random
sample without replacement of the whole mix. Shards then draw their blocks from the permuted list of each source, disjoint by
construction, and order their documents by a hash.

Everything is SQL functions. What depends on a source or a block is a small table; documents meet it in joins whose sides'
sizes Spark knows, and never one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import text_of, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, CAP, SEED = (5, 2, 1), 3, 0
#: Words of a block and of an output shard.
BLOCK_WORDS, SHARD_WORDS = 1 << 15, 1 << 22
#: Runs of the last pass: places after and up to, and the length above which documents are left out.
RUNS = "array<struct<after:bigint,upto:bigint,gap:double>>"
TAKEN = "exists(runs, r -> u > r.after and u <= r.upto and size <= r.gap) or array_contains(finish, u)"


def permutation(key: str, text: str, seed: int) -> Column:
    """48 bits of a hash of the row: its place in the permutation."""
    row = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|"), text_of(text))
    return F.conv(F.substring(F.md5(row), 1, 12), 16, 10).cast("long")


def sized(*, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> list[Column]:
    return [F.col(key).alias("doc_id"), F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"), F.col(source).alias("source"), permutation(key, text, seed).alias("u")]


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Written: source, number, source_size, target. Sources by code point, NULL last, weigh ``weights`` in turn; a target
    stops at ``cap`` times its source and the others share the excess by weight. One row per source in these windows."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighed = sizes.withColumn("number", number).withColumn("w", F.array(*map(F.lit, weights))[(F.col("number") % len(weights)).cast("int")])
    order = Window.orderBy(F.col("source_size") / F.col("w"), "number")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    leveled = weighed.withColumns({"level": level, "rank": F.row_number().over(order)}).withColumn("free", F.col("source_size") * cap / F.col("w") > F.col("level"))
    common = F.min(F.when(F.col("free"), F.struct("rank", "level"))).over(everything)["level"]
    target = F.when(F.col("free"), common * F.col("w")).otherwise((F.col("source_size") * cap).cast("double"))
    return written(leveled.select("source", "number", "source_size", target.alias("target")), "targets")


def _block() -> Column:
    return F.expr("shiftright(u, 24) * blocks div 16777216")


def plan(rows: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Written: for each source its target, the number of whole passes (``passes``), of blocks, and what the last pass takes: the
    documents of its ``runs`` and those at the places in ``finish``. ``quota``: block copies the mix takes."""
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = targets(rows, weights, cap).withColumns({"passes": passes, "blocks": F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")})
    sources = written(sources.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "passes")
    placed = _with_source(rows.select("source", "size", "u"), sources, "number", "blocks", "rest").where("rest > 0 and size > 0")
    none = {"after": F.lit(-1).cast("long"), "cut_u": F.lit(None).cast("long"), "runs": F.array().cast(RUNS), "finish": F.array().cast("array<bigint>")}
    state = sources.where("rest > 0").select("number", "blocks", F.col("rest").alias("gap")).withColumns(none)
    more = True
    while more:
        state = _run(placed, written(state, "state"), block_words)
        state, more = _largest(placed, state)
    finish = _closest(placed, state).select("number", "cut_u", "runs", "finish")
    whole = sources.join(finish, "number", "left").withColumn("cut_block", F.expr("if(cut_u is null, -1L, greatest(0L, shiftright(cut_u, 24) * blocks div 16777216))"))
    quota = F.col("passes") * F.col("blocks") + F.when(F.col("rest") > 0, F.col("cut_block") + 1).otherwise(0)
    columns = {"runs": F.coalesce("runs", F.array().cast(RUNS)), "finish": F.coalesce("finish", F.array().cast("array<bigint>")), "quota": F.coalesce(quota, F.lit(0))}
    return written(whole.withColumns(columns), "plan")


def _run(placed: DataFrame, state: DataFrame, block_words: int) -> DataFrame:
    """Written: ``state`` with one more run: behind the place ``after``, the longest prefix of the documents that are not longer
    than the gap. ``after`` moves to the document that ends it. Runs that start with less than a block's words do not move
    ``cut_u``, which bounds the blocks: their documents go to the last one."""
    live = F.expr("u > after and size <= gap and not array_contains(finish, u)")
    ahead = placed.join(state.select("number", "after", "gap", "finish"), "number").where(live).select("number", "gap", "u", "size", _block().alias("block"))
    upto = F.sum("words").over(Window.partitionBy("number").orderBy("block"))
    blocks = ahead.groupBy("number", "gap", "block").agg(F.sum("size").alias("words"), F.max("u").alias("last")).withColumn("upto", upto)
    ends = F.min(F.when(F.col("upto") > F.col("gap"), F.struct("block", (F.col("upto") - F.col("words")).alias("before"))))
    fits = F.max(F.when(F.col("upto") <= F.col("gap"), F.struct("upto", "last")))
    cut = written(blocks.groupBy("number").agg(ends.alias("ends"), fits.alias("fits")), "cut")
    at = cut.select("number", F.col("ends.block").alias("cut_at"), F.col("ends.before").alias("before")).where("cut_at is not null")
    inside = ahead.join(at, "number").where("block = cut_at")
    so_far = F.col("before") + F.sum("size").over(Window.partitionBy("number").orderBy("u"))  # a block's rows
    within = inside.withColumn("so_far", so_far).groupBy("number").agg(F.max(F.when(F.col("so_far") <= F.col("gap"), F.struct("so_far", "u"))).alias("p"), F.min(F.when(F.col("so_far") > F.col("gap"), F.col("u"))).alias("stop"))
    found = cut.join(within, "number", "left").select("number", F.coalesce("p.so_far", "fits.upto", F.lit(0)).alias("got"), F.coalesce("p.u", "fits.last").alias("to"), F.coalesce("stop", "fits.last").alias("stop"))
    joined = state.join(found, "number", "left")
    run = F.struct("after", F.coalesce("to", "after").alias("upto"), "gap")
    return written(
        joined.select(
            "number", "blocks", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap"), F.coalesce("stop", "after").alias("after"),
            F.when(F.col("cut_u").isNull() | (F.col("gap") >= block_words), F.coalesce("to", "cut_u", "after")).otherwise(F.col("cut_u")).alias("cut_u"),
            F.when(F.col("to").isNull(), F.col("runs")).otherwise(F.concat("runs", F.array(run))).cast(RUNS).alias("runs"), "finish",
        ),
        "state",
    )


def _best(placed: DataFrame, state: DataFrame, where: str) -> DataFrame:
    """``state`` and the place that misses the gap least (``best``) among those that ``where`` admits. Rows that share a place go together."""
    free = placed.join(state.select("number", "gap", "after", "runs", "finish"), "number").where(f"not ({TAKEN})")
    places = free.groupBy("number", "gap", "after", "u").agg(F.sum("size").alias("size")).where(where)
    best = places.groupBy("number").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("miss"), "u", "size")).alias("best"))
    joined = state.join(best, "number", "left")
    gap = F.col("gap") - F.coalesce("best.size", F.lit(0))
    finish = F.when(F.col("best").isNull(), F.col("finish")).otherwise(F.concat("finish", F.array("best.u")))
    return joined.select("number", "blocks", gap.alias("gap"), "after", "cut_u", "runs", finish.alias("finish"), F.col("best").isNotNull().alias("more"))


def _largest(placed: DataFrame, state: DataFrame) -> tuple[DataFrame, bool]:
    """The largest document behind that still fits; with the runs, this halves the gap each time or leaves none that fits."""
    found = written(_best(placed, state, "u > after and size <= gap"), "finish")
    return found.drop("more"), not found.where("more").isEmpty()


def _closest(placed: DataFrame, state: DataFrame) -> DataFrame:
    """The document that brings the last pass closer to the target from above, if there is one."""
    return written(_best(placed, state, "abs(size - gap) < gap"), "finish")


def _with_source(rows: DataFrame, sources: DataFrame, *columns: str) -> DataFrame:
    of = sources.select(F.col("source").alias("_of"), *columns)
    return rows.join(of, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")


def _split(node: str) -> str:
    """SQL: how many blocks of each source go left. ``quotas`` is the node's array, ``node`` its number.

    A draw inverts the distribution function, summed over twelve standard deviations around the mean from the ratio of
    neighbouring probabilities; beyond lies less than 1e-30. Of ``blocks`` that remain, ``own`` are the source's and ``n`` go left.
    """
    let = lambda name, value, body: f"aggregate(array({value}), 0L, (unused, {name}) -> {body})"
    spread = "sqrt(q.n * (q.own / q.blocks) * (1 - q.own / q.blocks) * (q.blocks - q.n) / greatest(1L, q.blocks - 1))"
    range_ = f"""named_struct('blocks', q.blocks, 'own', q.own, 'n', q.n, 'u', q.u,
        'lo', greatest(0L, q.n - (q.blocks - q.own), cast(floor(q.n * (q.own / q.blocks) - 12 * {spread}) as bigint) - 1),
        'hi', least(q.n, q.own, cast(ceil(q.n * (q.own / q.blocks) + 12 * {spread}) as bigint) + 1))"""
    ratio = "(r.own - k) * (r.n - k) / ((k + 1D) * (r.blocks - r.own - r.n + k + 1D))"
    total = f"aggregate(sequence(r.lo, r.hi), named_struct('w', 1D, 's', 0D), (a, k) -> named_struct('w', a.w * {ratio}, 's', a.s + a.w), a -> a.s)"
    draw = f"""aggregate(sequence(r.lo, r.hi), named_struct('w', 1D, 's', 0D, 'k', r.lo),
        (a, k) -> named_struct('w', a.w * {ratio}, 's', a.s + a.w, 'k', if(a.s + a.w < r.u * total, least(r.hi, k + 1), a.k)), a -> a.k)"""
    drawn = let("r", range_, let("total", total, draw))
    u = f"shiftrightunsigned(xxhash64({node}, size(acc.left)), 11) / 9007199254740992D"
    one = let("q", f"named_struct('blocks', acc.blocks, 'own', own, 'n', acc.n, 'u', {u})", f"if(q.blocks = 0 or q.own = 0 or q.n = 0, 0L, {drawn})")
    step = f"aggregate(array({one}), acc, (b, x) -> named_struct('blocks', b.blocks - own, 'n', b.n - x, 'left', concat(b.left, array(x))))"
    whole = "aggregate(quotas, 0L, (s, x) -> s + x)"
    start = f"named_struct('blocks', {whole}, 'n', {whole} div 2, 'left', cast(array() as array<bigint>))"
    return f"aggregate(quotas, {start}, (acc, own) -> {step}, acc -> acc.left)"


def shards(sources: DataFrame, *, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """Written: the shard of each block copy (number, copy). The tree has one level for each doubling of the shards."""
    words = sources.agg(F.sum("target")).first()[0] or 0.0
    levels = max(0, math.ceil(math.log2(max(1.0, words / shard_words))))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("number", "quota"))), lambda x: x["quota"])
    nodes = sources.agg(ordered.alias("quotas")).select(F.lit(1).cast("long").alias("node"), "quotas")  # one number for each source
    for _ in range(levels):
        halves = nodes.withColumn("left", F.expr(_split(f"node + {seed}")))
        right = F.zip_with("quotas", "left", lambda a, b: a - b)
        nodes = written(halves.select(F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")), F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quotas")))).alias("half")).select("half.*"), "nodes")
    quotas = nodes.select((F.col("node") - (1 << levels)).alias("shard"), F.posexplode("quotas").alias("at", "n"))
    first = F.sum("n").over(Window.partitionBy("at").orderBy("shard")) - F.col("n")
    slots = quotas.withColumn("first", first).where("n > 0").select("at", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot"))
    numbers = sources.select("number", F.row_number().over(Window.orderBy("number")).alias("at"), "quota").withColumn("at", F.col("at") - 1)
    copies = numbers.where("quota > 0").select("number", "at", F.explode(F.expr("sequence(0L, quota - 1)")).alias("copy"))
    permuted = copies.withColumn("slot", (F.row_number().over(Window.partitionBy("at").orderBy(F.xxhash64(F.lit(seed), "number", "copy"), "copy")) - 1).cast("long"))
    return written(permuted.join(slots, ["at", "slot"]).select("number", "copy", "shard"), "shards")


def drawn(rows: DataFrame, sources: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` with ``pass`` and ``shard``: once for each time the mix takes them, and once with NULLs if never."""
    columns = ("number", "blocks", "source_size", "target", "passes", "cut_block", "runs", "finish")
    placed = _with_source(rows, sources, *columns).withColumn("block", _block())
    part = F.expr(TAKEN)
    times = F.col("passes") + F.when(part, 1).otherwise(0)
    taken = placed.withColumn("pass", F.explode_outer(F.when(times > 0, F.sequence(F.lit(0).cast("long"), times - 1))))
    copy = F.col("pass") * F.col("blocks") + F.when(F.col("pass") < F.col("passes"), F.col("block")).otherwise(F.least("block", "cut_block"))
    on = blocks.select(F.col("number").alias("_number"), F.col("copy").alias("_copy"), "shard")
    joined = taken.withColumn("copy", copy).join(on, (F.col("number") == F.col("_number")) & (F.col("copy") == F.col("_copy")), "left")
    return joined.drop("_number", "_copy")


def mixed(docs: DataFrame, *, seed: int = SEED, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, shards (where its copies go).

    A NULL text has size 0; documents of size 0 are never short of their target. NULL is a source of its own. Rows that
    repeat key and text share their place in the permutation. An empty table gives no rows.
    """
    rows = docs.select(*sized(key=key, text=text, source=source, seed=seed), F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "sizes")
    sources = plan(rows)
    draws = drawn(rows, sources, shards(sources, seed=seed))
    per_row = draws.groupBy("row", "doc_id", "size", "source_size", "target").agg((F.count("shard") * F.col("size")).alias("taken"), F.sort_array(F.collect_list("shard")).alias("shards"))
    return per_row.select("doc_id", "size", "source_size", "target", "taken", "shards")


def mixture(docs: DataFrame, *, seed: int = SEED, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are drawn, all columns, shard by shard in shuffled order."""
    computed = sized(key=key, text=text, source=source, seed=seed)
    rows = written(docs.select(*computed), "sizes")
    sources = plan(rows)
    whole = docs.select(F.struct("*").alias("row"), *computed)
    draws = drawn(whole, sources, shards(sources, seed=seed)).where("shard is not null")
    order = F.xxhash64(F.lit(seed), "u", "pass")
    return draws.select("row", "shard", order.alias("order")).repartition("shard").sortWithinPartitions("shard", "order").select("row.*")

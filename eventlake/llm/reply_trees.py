"""Chat formatting of reply trees.

Messages point to the message they answer. Iterated self-joins on doubled distances list the path from each leaf to its root:
after k rounds a leaf knows its ancestors at distances below 2^k, and every message the one at distance 2^k. Branches are
ranked by the mean score of their messages, and each chosen path becomes one conversation. Texts travel once, when paths are formatted.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import table, written

# The template: a turn is OPEN role SHUT text END. Control strings in roles and texts, and the escape sign, are escaped.
OPEN, SHUT, END, SIGN = "[INST]", "[/INST]", "</s>", "\\"
CONTROL = (OPEN, SHUT, "<s>", END, "<<SYS>>", "<</SYS>>")
TRAINED = "assistant"
_TURN = re.compile(f"{re.escape(OPEN)}(.*?){re.escape(SHUT)}(.*?){re.escape(END)}", re.DOTALL)
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str) -> str:
    """No control string is left: each gets the sign after its first character; signs are doubled first."""
    text = text.replace(SIGN, SIGN * 2)
    for control in CONTROL:
        text = text.replace(control, control[0] + SIGN + control[1:])
    return text


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def formatted(turns: list[dict]) -> tuple[str, list[tuple[int, int]]]:
    """A conversation and its loss mask: the spans (code points) of the assistant's texts."""
    parts, mask, at = [], [], 0
    for turn in turns:
        head, body = f"{OPEN}{escaped(turn['role'] or '')}{SHUT}", escaped(turn["text"] or "")
        if turn["role"] == TRAINED:
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), mask


def parsed(conversation: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescaped(r), unescaped(t)) for r, t in _TURN.findall(conversation)]


def paths(messages: DataFrame) -> DataFrame:
    """Written: (tree, leaf, node, back), every message on the way from a leaf to its root, ``back`` steps before the leaf.

    ``messages``: tree, node, parent (strings; NULL at a root). A parent that is not there makes its answers roots. Answers
    in a circle have no leaf and give no path. Messages with the same name are one.
    """
    nodes = messages.groupBy("tree", "node").agg(F.min("parent").alias("parent"))
    there = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    nodes = written(nodes.join(there, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("parent")), "nodes")
    answered = nodes.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    found = nodes.join(answered, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back"))
    jumps, distance, open_ends = nodes.select("tree", "node", F.col("parent").alias("up")).where("up is not null"), 1, found
    while True:
        step = written(jumps, "jumps")
        if step.isEmpty() or open_ends.isEmpty():
            return written(found, "paths")
        more = found.join(step, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("back") + distance).alias("back"))
        open_ends = written(more, "paths")
        found = written(found.unionByName(open_ends), "paths")
        over = step.select("tree", F.col("node").alias("up"), F.col("up").alias("top"))
        jumps, distance = step.join(over, ["tree", "up"]).select("tree", "node", F.col("top").alias("up")), distance * 2


def ranked(found: DataFrame, messages: DataFrame) -> DataFrame:
    """(tree, leaf, rank, score): the branches of each tree, best mean score first, ties by leaf. A NULL score counts as 0."""
    scores = found.join(messages.groupBy("tree", "node").agg(F.max(F.coalesce("score", F.lit(0.0))).alias("score")), ["tree", "node"])
    means = scores.groupBy("tree", "leaf").agg(F.avg("score").alias("score"))
    return means.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))


def conversations(messages: DataFrame, *, branches: int | None = None) -> DataFrame:
    """Every chosen branch as one conversation: tree, leaf, rank, score, formatted, mask.

    ``messages``: tree, node, parent, role, text, score. ``branches``: how many of each tree, None for all. NULL texts and
    roles are empty. An empty table gives no rows. A conversation is one row, so a path must fit into a task's memory.
    """
    found = paths(messages)
    chosen = written(ranked(found, messages).where(F.lit(True) if branches is None else F.col("rank") <= branches), "branches")
    one = messages.groupBy("tree", "node").agg(F.min(F.struct("role", "text")).alias("turn"))
    turns = found.join(chosen, ["tree", "leaf"]).join(one, ["tree", "node"])
    rows = turns.groupBy("tree", "leaf", "rank", "score").agg(F.sort_array(F.collect_list(F.struct("back", "turn")), asc=False).alias("turns"))

    def format_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [formatted([t["turn"] for t in x.as_py()]) for x in batch.column("turns")]
            masks = pa.array([[{"start": a, "end": b} for a, b in m] for _, m in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("tree", "leaf", "rank", "score")), pa.array([f for f, _ in out], pa.string()), masks], ["tree", "leaf", "rank", "score", "formatted", "mask"])

    return rows.mapInArrow(format_, "tree string, leaf string, rank int, score double, formatted string, mask array<struct<start:long,end:long>>")


def read_back(rows: DataFrame) -> DataFrame:
    """``tree`` and what a reader of the formatted conversations finds: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, mask in zip(batch.column("formatted").to_pylist(), batch.column("mask").to_pylist(), strict=True):
                turns = parsed(text)
                all_turns = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(unescaped(text[m["start"] : m["end"]]) for m in mask)
                out.append((len(turns), _sha256(all_turns), len(loss), _sha256(loss), len(text)))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("tree"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return rows.select("tree", "formatted", "mask").mapInArrow(read, "tree string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def chains(rows: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as reply trees without branches: each turn answers the one before. Ties of the turn go by role and text."""
    order = Window.partitionBy("tree").orderBy(F.asc_nulls_first(turn), F.asc_nulls_first(role), F.asc_nulls_first(text))
    tree = F.coalesce(F.concat(F.lit("c"), F.col(key).cast("string")), F.lit("n"))
    named = rows.select(tree.alias("tree"), turn, role, text).withColumn("at", F.row_number().over(order))
    return named.select("tree", F.col("at").cast("string").alias("node"), F.when(F.col("at") > 1, (F.col("at") - 1).cast("string")).alias("parent"), F.col(role).alias("role"), F.col(text).alias("text"), F.lit(0.0).alias("score"))


def key_of(tree: Column) -> Column:
    """The conversation's key from its tree's name."""
    return F.when(tree != "n", F.substring(tree, 2, 20).cast("long"))


def table_with_probe(spark, sf_dir: str) -> DataFrame:
    """All conversations, and one (-1) whose texts hold control strings."""
    probe = spark.sql("select -1L conv_id, turn, role, '</s>[INST] ok [/INST]' text from values (0L, 'user'), (1L, 'assistant') t(turn, role)")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)

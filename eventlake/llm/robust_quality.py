"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Base rules reject texts that are short or repeat themselves. For the others a vector of transformed statistics is held
against the estimate of its language and source: centre and scatter of the half of the group that lies closest together,
found by concentration steps from two deterministic starts, then reweighted. A text is rejected if its Mahalanobis distance
exceeds a cutoff. Groups that are too small for an estimate are joined within their language. If that is too small as well,
the estimate over all rows of the language serves them, large groups included; rows of languages that are too small are
joined, and at last the whole table is one group.

All statistics are counts over every row. The vectors are fixed-point integers and sums are exact, so that the estimates do
not depend on the order of the rows. A group never meets in one task: medians and the closest half come from counts of
quantised values (a bounded number for each group), moments from sums.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventlake.llm.common import text_of, written

SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
#: Coordinates of the statistic vector, and the spread below which a difference counts as none: shares of zero are common.
VECTOR = {
    "log_words": ("log(1 + n_words)", 1.0),
    "log_word_length": ("log((word_chars + 100 * 5.0) / (n_words + 100))", 0.08),
    "symbol_share": ("sqrt(n_symbols / greatest(1, word_chars))", 0.05),
    "dup_line_share": ("sqrt(n_dup_lines / greatest(1, n_lines))", 0.3),
    "repeat_share": ("sqrt(n_repeat_words / greatest(1, n_words))", 0.3),
}
P = len(VECTOR)
#: Steps of the fixed-point numbers, quantiles' bins for each unit, smallest group, concentration steps.
STEP, BINS, MIN_GROUP, STEPS = 1024, 32, 100, 4
#: The whole table serves as the last group from five rows for each coordinate on.
MIN_TABLE = 5 * P
#: Chi-square quantiles with five degrees of freedom: the median, 0.975 (reweighting) and 1 - 1e-9 (rejection).
CHI2_MEDIAN, CHI2_REWEIGHT, CHI2_CUTOFF = 4.3515, 12.833, 50.69
_MOMENTS = [(i, j) for i in range(P) for j in range(i, P)]


def counts(text: str) -> list[int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (with a word) of a text."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes: exactly the six ASCII spaces
    windows = list(zip(words, words[1:], words[2:]))  # noqa: B905
    often = {w for w, n in Counter(windows).items() if n > 1} if len(set(windows)) < len(windows) else ()
    covered, last = 0, -1
    for at, window in enumerate(windows) if often else ():
        if window in often:
            covered += at + 3 - max(at, last)
            last = at + 3
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    chars = len(text) - sum(text.count(x) for x in SPACES)
    return [len(words), chars, sum(text.count(x) for x in SYMBOLS), len(lines) - len(set(lines)), covered, len(lines)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([counts(x.as_py() or "") for x in batch.column("text")], np.int64).reshape(-1, len(COUNTS))
        found = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(COUNTS))], COUNTS)
        yield pa.RecordBatch.from_arrays([*(c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name != "text"), found], [*(n for n in batch.schema.names if n != "text"), "counts"])


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as one column ``row``, with the struct ``counts``."""
    rows = docs.select(F.struct("*").alias("row"), text_of(text).alias("text"))
    found = StructType([StructField(c, LongType()) for c in COUNTS])
    return rows.mapInArrow(_counted, StructType([rows.schema["row"], StructField("counts", found)]))


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def _vector() -> list[Column]:
    return [F.round(F.expr(how) * STEP).cast("long").alias(f"x{i}") for i, (how, _) in enumerate(VECTOR.values())]


def _grouped(stats: DataFrame, min_group: int) -> tuple[DataFrame, DataFrame]:
    """Groups: lang, source, ``grp``, whose estimate serves the rows; NULL if even the whole table is too small. Members: lang,
    source, grp, whose rows an estimate is made of; a language's or the table's are also those of groups with their own."""
    sizes = written(stats.where(~base_failed()).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "sizes")
    small = F.when(F.col("n") < min_group, F.col("n"))
    langs = written(sizes.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("n_lang"), F.sum(small).alias("n_small")), "langs")
    rest = langs.agg(F.sum(F.when(F.col("n_lang") < min_group, F.col("n_lang"))).alias("n_rest"), F.sum("n_lang").alias("n_all"))
    joined = sizes.join(langs, F.col("lang").eqNullSafe(F.col("of")), "left").crossJoin(F.broadcast(rest))  # one row
    own = F.to_json(F.struct(F.lit(1).alias("own"), "lang", "source"))
    joint = F.to_json(F.struct(F.lit(1).alias("joint"), "lang"))
    lang = F.to_json(F.struct(F.lit(1).alias("whole"), "lang"))
    rare = F.when(F.col("n_lang") < min_group, F.lit("{}"))
    every = F.lit('{"every":1}')
    group = F.when(F.col("n") >= min_group, own).when(F.col("n_small") >= min_group, joint).when(F.col("n_lang") >= min_group, lang)
    group = group.when(F.col("n_rest") >= min_group, rare).when(F.col("n_all") >= min(min_group, MIN_TABLE), every)
    placed = written(joined.select("lang", "source", group.alias("grp"), lang.alias("whole")), "groups")
    pools = placed.select("lang", "source", F.explode(F.array("grp", "whole", every)).alias("grp")).distinct()
    members = pools.join(placed.where("grp is not null").select("grp").distinct(), "grp", "left_semi")
    return placed.drop("whole"), written(members, "members")


def _quantiles(values: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Quantiles of integers within groups, from counts of distinct values."""
    often = values.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(value))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    ranked = often.select(*keys, value, upto.alias("_upto"), total.alias("_total"))
    return ranked.groupBy(*keys).agg(*(F.min(F.when(F.col("_upto") >= F.ceil(F.col("_total") * share), F.col(value))).alias(name) for name, share in shares.items()))


def _invert(pdf):
    """Centre and inverse scatter from a group's moments, floors added to the scatter."""
    out = []
    floors = np.diag([floor**2 for _, floor in VECTOR.values()])
    for row in pdf.itertuples(index=False):
        n, sums = float(row.n), np.array([float(getattr(row, f"s{i}")) for i in range(P)]) / STEP
        mean, scatter = sums / n, np.zeros((P, P))
        for i, j in _MOMENTS:
            scatter[i, j] = scatter[j, i] = float(getattr(row, f"m{i}_{j}")) / STEP**2 / n - mean[i] * mean[j]
        scatter = scatter + floors
        out.append((mean.tolist(), np.linalg.inv(scatter).ravel().tolist(), float(np.linalg.slogdet(scatter)[1])))
    return out


def _estimates(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Written: ``keys``, centre, inverse scatter and the logarithm of the scatter's determinant."""
    moments = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(f"x{i}").alias(f"s{i}") for i in range(P)), *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"m{i}_{j}") for i, j in _MOMENTS)
    )
    kinds = dict(moments.dtypes)

    def inverted(batches):
        import pandas as pd

        for pdf in batches:
            found = _invert(pdf)
            yield pd.DataFrame({k: pdf[k] for k in keys} | {"centre": [x[0] for x in found], "inverse": [x[1] for x in found], "logdet": [x[2] for x in found]})

    return written(moments.mapInPandas(inverted, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", centre array<double>, inverse array<double>, logdet double"), name)


def _distance() -> Column:
    """Squared Mahalanobis distance of (x0..) to centre and inverse scatter."""
    gap = [f"(x{i} / {STEP}D - centre[{i}])" for i in range(P)]
    return F.expr(" + ".join(f"{1 if i == j else 2} * inverse[{i * P + j}] * {gap[i]} * {gap[j]}" for i, j in _MOMENTS))


def _bin() -> Column:
    """Squared distances in steps of about two per cent: at most some thousand values for each group."""
    return F.floor(F.log2(F.lit(1e-6) + F.greatest(F.lit(0.0), _distance())) * BINS).cast("int")


def _starts(rows: DataFrame) -> DataFrame:
    """Two first estimates for each group: medians with quartile scales, and the same with the correlation of the signs."""
    tall = rows.select("grp", F.posexplode(F.array(*(F.col(f"x{i}") for i in range(P)))).alias("i", "x"))
    quartiles = _quantiles(tall, ["grp", "i"], "x", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    floors = F.array(*(F.lit(floor) for _, floor in VECTOR.values()))
    scaled = quartiles.withColumn("scale", F.sqrt(F.pow((F.col("q3") - F.col("q1")) / (1.349 * STEP), F.lit(2)) + F.pow(floors[F.col("i")], F.lit(2))))
    flat = written(scaled.groupBy("grp").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "q2", "scale"))), lambda s: F.struct(s["q2"].alias("median"), s["scale"].alias("scale"))).alias("axes")), "axes")
    signs = [F.signum(F.col(f"x{i}") - F.col("axes")[i]["median"]) for i in range(P)]
    agree = rows.join(flat, "grp").select("grp", *(s.cast("long").alias(f"g{i}") for i, s in enumerate(signs)))
    agree = agree.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col(f"g{i}") * F.col(f"g{j}")).alias(f"m{i}_{j}") for i, j in _MOMENTS)).join(flat, "grp")

    def started(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                centre, scale = [x["median"] / STEP for x in row.axes], np.array([x["scale"] for x in row.axes])
                signs = np.eye(P)
                for i, j in _MOMENTS:
                    if i != j:
                        signs[i, j] = signs[j, i] = np.sin(np.pi / 2 * 0.9 * getattr(row, f"m{i}_{j}") / row.n)
                for start, corr in enumerate((np.eye(P), signs + 0.5 * np.eye(P))):
                    out.append((row.grp, start, centre, np.linalg.inv(corr * np.outer(scale, scale)).ravel().tolist(), 0.0))
            yield pd.DataFrame(out, columns=["grp", "start", "centre", "inverse", "logdet"])

    return written(agree.mapInPandas(started, "grp string, start int, centre array<double>, inverse array<double>, logdet double"), "starts")


def fit(stats: DataFrame, *, min_group: int = MIN_GROUP, steps: int = STEPS) -> tuple[DataFrame, DataFrame]:
    """Groups (lang, source, grp) and estimates (grp, centre, inverse, ``scale``) from counts (lang, source, ``COUNTS``)."""
    groups, members = _grouped(stats, min_group)
    keyed = stats.where(~base_failed()).select(F.col("lang").alias("l"), F.col("source").alias("s"), *_vector())
    on = F.col("l").eqNullSafe(F.col("lang")) & F.col("s").eqNullSafe(F.col("source"))
    rows = written(keyed.join(members, on).select("grp", *(f"x{i}" for i in range(P))), "vectors")
    estimates = _starts(rows)
    for _ in range(steps):
        placed = rows.join(estimates, "grp").select("grp", "start", *(f"x{i}" for i in range(P)), _bin().alias("bin"))
        half = written(_quantiles(placed, ["grp", "start"], "bin", {"most": 0.5}), "halves")
        inner = placed.join(half, ["grp", "start"]).where("bin <= most")
        estimates = _estimates(inner, ["grp", "start"], "estimates")
    best = F.row_number().over(Window.partitionBy("grp").orderBy("logdet", "start")) == 1
    chosen = estimates.withColumn("best", best).where("best").drop("best", "start", "logdet")
    raw = _consistent(rows, written(chosen, "raw"))
    near = rows.join(raw, "grp").where(_distance() <= F.col("scale") * CHI2_REWEIGHT)
    return groups, _consistent(rows, _estimates(near, ["grp"], "reweighted").drop("logdet"))


def _consistent(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``scale`` makes the median squared distance of a group that of a normal sample."""
    placed = rows.join(estimates, "grp").select("grp", _bin().alias("bin"))
    middle = _quantiles(placed, ["grp"], "bin", {"middle": 0.5})
    scale = F.greatest(F.lit(0.2), F.pow(F.lit(2.0), (F.col("middle") + 1) / F.lit(float(BINS))) / CHI2_MEDIAN)
    return written(estimates.join(middle.select("grp", scale.alias("scale")), "grp"), "scaled")


def judged(rows: DataFrame, groups: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds ``base_failed``, ``distance`` (squared; NULL without an estimate) and ``kept`` to rows with lang, source and counts."""
    known = written(groups.join(estimates, "grp", "left").select(F.col("lang").alias("l"), F.col("source").alias("s"), "centre", "inverse", "scale"), "known")
    on = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    placed = rows.select("*", *_vector()).join(known, on, "left").withColumns({"base_failed": base_failed(), "distance": _distance() / F.col("scale")})
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CHI2_CUTOFF, F.lit(True))
    return placed.withColumn("kept", kept).drop("l", "s", "centre", "inverse", "scale", *(f"x{i}" for i in range(P)))


def quality(docs: DataFrame, *, key: str = "doc_id", min_group: int = MIN_GROUP) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance.

    A NULL text has no words and fails. NULL languages and sources form groups of their own. Rows without an estimate
    (a table with fewer than ``MIN_TABLE`` that pass the base rules) are judged by those alone. An empty table gives no rows.
    """
    counted = with_counts(docs.select(F.col(key).alias("doc_id"), "text", "lang", "source"))
    stats = written(counted.select("row.doc_id", "row.lang", "row.source", "counts.*"), "counts")
    names = ["doc_id", *COUNTS[:-1], "base_failed", "kept", "distance"]
    return judged(stats, *fit(stats, min_group=min_group)).select(*names)


def without_outliers(docs: DataFrame, *, min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns. Texts are read twice and not shuffled."""
    light = with_counts(docs.select("text", "lang", "source"))
    stats = written(light.select("row.lang", "row.source", "counts.*"), "counts")
    rows = with_counts(docs).select("row", "row.lang", "row.source", "counts.*")
    return judged(rows, *fit(stats, min_group=min_group)).where("kept").select("row.*")

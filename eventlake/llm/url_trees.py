"""URL filters: rules, and gradient-boosted trees on lexical features for the urls that no rule fits.

Features are SQL expressions: length, depth, share of digits, entropy, number of parameters, and how often the host's suffix
is blocked among the labelled urls. Labels come from the rules (or a column of the caller's); the trees are fitted on a
sample of the labelled urls of bounded size, drawn by hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import written


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["n_chars", "host_chars", "depth", "digit_share", "entropy", "n_params", "n_hyphens", "n_labels", "longest_label", "suffix_rate", "suffix_rows"]
#: Most labelled urls the trees see, and what a suffix's block rate is drawn to, as if from so many urls.
SAMPLE, PRIOR_ROWS, TREES, DEPTH = 20_000, 20.0, 10, 3


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting(rules: tuple[Rule, ...], what: str) -> Column:
    """Name or verdict of the longest rule that fits (host, path); NULL if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        on_host = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
        found = F.when(on_host & F.startswith(F.col("path"), F.lit(rule.path)), F.lit(getattr(rule, what))).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits for each character."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c))) / n
    return F.when(n == 0, 0.0).otherwise(-F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda s, c: s + F.when(F.length(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0)))


def lexical(rows: DataFrame) -> DataFrame:
    """Adds the features that a url has by itself, and ``suffix``: the last two labels of its host."""
    url, parts = F.coalesce("url", F.lit("")), F.split("host", r"\.")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return rows.withColumns({
        "n_chars": F.length(url).cast("double"),
        "host_chars": F.length("host").cast("double"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"),
        "digit_share": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.lit(1), F.length(url)),
        "entropy": _entropy(url),
        "n_params": F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double"),
        "n_hyphens": (F.length("host") - F.length(F.replace("host", F.lit("-")))).cast("double"),
        "n_labels": F.size(parts).cast("double"),
        "longest_label": F.array_max(F.transform(parts, F.length)).cast("double"),
        "suffix": F.substring_index("host", ".", -2),
    })


def suffixes(labelled: DataFrame) -> DataFrame:
    """Written: for each suffix the share of blocked urls among the labelled, drawn to the overall share, and their number."""
    whole = labelled.agg(F.avg("label").alias("overall"))
    counts = labelled.groupBy("suffix").agg(F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("n"))
    rate = (F.col("blocked") + PRIOR_ROWS * F.col("overall")) / (F.col("n") + PRIOR_ROWS)
    return written(counts.crossJoin(F.broadcast(whole)).select(F.col("suffix").alias("_suffix"), rate.alias("suffix_rate"), F.log1p("n").alias("suffix_rows")), "suffixes")  # one row


def _with_suffix(rows: DataFrame, found: DataFrame) -> DataFrame:
    joined = rows.join(found, F.col("suffix") == F.col("_suffix"), "left").drop("_suffix")
    return joined.withColumns({"suffix_rate": F.coalesce("suffix_rate", F.lit(0.5)), "suffix_rows": F.coalesce("suffix_rows", F.lit(0.0))})


def scored(rows: DataFrame, label: str, *, sample: int = SAMPLE, seed: int = 0) -> DataFrame:
    """Adds ``blocked``, the trees' probability, to rows with url, host, path and a label (1 block, 0 allow, NULL unknown).

    Without labelled urls of both kinds nothing can be learned: the probability is the share of blocked ones, 0 without any.
    """
    features = lexical(rows.withColumn("label", F.col(label).cast("double")))
    labelled = features.where("label is not null")
    facts = labelled.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate")).first()
    if facts["n"] == 0 or facts["rate"] in (0.0, 1.0):
        return features.withColumn("blocked", F.lit(facts["rate"] or 0.0))
    known = suffixes(labelled)
    share = min(1.0, sample / facts["n"])
    drawn = F.pmod(F.xxhash64("url", "page_id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))
    train = written(_with_suffix(labelled.where(drawn), known).select("label", *FEATURES).repartition(4), "training")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed, subsamplingRate=1.0)
    if train.select("label").distinct().count() < 2:
        return features.withColumn("blocked", F.lit(facts["rate"]))
    model = trees.fit(assembler.transform(train).select("label", "features"))
    from pyspark.ml.functions import vector_to_array

    judged = model.transform(assembler.transform(_with_suffix(features, known)))
    return judged.withColumn("blocked", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def filtered(pages: DataFrame, *, rules: tuple[Rule, ...] = RULES, key: str = "page_id", url: str = "url", label: str | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, blocked (probability).

    A NULL url, and one without ``://``, has an empty host and path, fits no rule, and is judged by the trees. ``label`` names a
    column with 1 (block), 0 or NULL; by default a url's label is its rule's verdict. Repeated rows are judged alike. An empty
    table gives no rows.
    """
    given = F.lit(None).cast("int") if label is None else F.col(label).cast("int")
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), given.alias("given")).withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rows = rows.withColumns({"rule": fitting(rules, "name"), "said": fitting(rules, "verdict")})
    rows = written(rows.withColumn("known", F.coalesce("given", F.when(F.col("said") == "block", 1).when(F.col("said") == "allow", 0))), "urls")
    verdict = F.coalesce("said", F.when(F.col("blocked") > 0.5, "block").otherwise("allow"))
    return scored(rows, "known", sample=sample).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "blocked")

"""The registered queries of the subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import frames, golomb_dedup, merkle_manifest, mixing, mixture_packing, ngram_join, packing, prefix_trie, reply_trees, robust_quality, secret_links, site_templates, url_trees
from eventlake.llm.common import table
from eventlake.llm.tokens import REMEMBERED_ALONE
from eventlake.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
Query = Callable[[SparkSession, str], DataFrame]


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def _pages(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "pages"))


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.round_trip(table(spark, sf_dir, "documents"), scratch_path(spark, "frames"), TOKENIZER)


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = reply_trees.chains(reply_trees.table_with_probe(spark, sf_dir))
    found = reply_trees.read_back(reply_trees.conversations(messages))
    return found.select(reply_trees.key_of(F.col("tree")).alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def queries() -> dict[str, Query]:
    from corpus_pipeline import run

    return {
        "op1_robust_outliers": _documents(robust_quality.quality),
        "op2_ngram_jaccard_join": _documents(ngram_join.near_duplicates),
        "op3_credential_linking": _documents(secret_links.scan),
        "op4_certified_packing": _documents(lambda docs: packing.packed(docs, TOKENIZER, remembered=REMEMBERED_ALONE)),
        "op5_hypergeometric_mixing": _documents(mixing.mixed),
        "op6_seekable_frames": _frames,
        "op7_site_templates": _pages(site_templates.extracted),
        "op8_reply_trees": _replies,
        "op9_url_trees": _pages(url_trees.filtered),
        "op10_golomb_dedup": _documents(golomb_dedup.exact_duplicates),
        "op11_prefix_trie": lambda spark, sf_dir: prefix_trie.families(table(spark, sf_dir, "conversations")),
        "op12_merkle_manifest": _documents(merkle_manifest.tampered_rows),
        "op13_mixture_packing": _documents(lambda docs: mixture_packing.packed(docs, TOKENIZER)),
        "pipeline": run,
    }

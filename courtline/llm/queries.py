"""The registered queries ``opN_<name>`` and their SQL.

Each query applies its operator, with production parameters, to its whole
table and derives the digest columns of its result from the operator's rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import TOOLS, format_chat, with_tools
from .exact_dedup import exact_dedup
from .html_extract import extract
from .licenses import scan, summary
from .line_dedup import dedup_lines
from .merkle import manifest
from .mixing import plan
from .near_dedup import near_duplicates
from .oracles import ORACLE  # noqa: F401
from .packing import pack
from .quality import quality_rules
from .storage import importable, table
from .token_counts import token_counts
from .toxicity import toxicity
from .turn_repair import repair_damaged

WORD_BPE = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(importable(spark), sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(docs, public_tokenizers.path(WORD_BPE), limit=2048)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), capacity=4096, end_id=1)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality_rules(docs).select("doc_id", *columns)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower half of the ids is the corpus seen before, the rest a new batch."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    middle = docs.agg(F.expr("percentile_approx(doc_id, 0.5)")).first()[0]
    old = F.coalesce(F.col("doc_id") <= F.lit(middle).cast("long"), F.lit(False))
    return exact_dedup(docs.where(~old), docs.where(old))


@query
def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = F.expr("aggregate(draws, 0L, (a, d) -> a + d.words)")
    return plan(docs).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


@query
def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, width=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), "text")


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = format_chat(with_tools(table(spark, sf_dir, "conversations")), TOOLS)
    return events.withColumn("problems", F.array_join("problems", "; "))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents")).drop("path")


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = summary(scan(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))

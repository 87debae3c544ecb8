"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import byte_bpe, centroid_clustering, chat_format, decontaminate, line_dedup, quality_rules, simhash, substring_dedup, token_alignment, token_files, toxicity, url_filter, warc
from folioflow.llm.common import table

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return put


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of repeated spans, and where those stand first."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as Simple-8b blocks and read back."""
    return token_files.digest(table(spark, sf_dir, "documents"), WORD_BPE, special=True)


@query("op3_line_dedup", line_dedup.ORACLE)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines found in ten documents or more."""
    return line_dedup.digest(table(spark, sf_dir, "documents"))


@query("op4_decontaminate", decontaminate.ORACLE)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_url_filter", url_filter.oracle())
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by what the labels outside the held-out fold teach."""
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_chat_format", chat_format.ORACLE)
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that no other one continues, rendered."""
    return chat_format.collapse_and_render(table(spark, sf_dir, "conversations"))


@query("op8_quality_rules", quality_rules.ORACLE)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, with the verdicts on itself and on its source."""
    return quality_rules.digest(table(spark, sf_dir, "documents"))


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes that they decode to, as digests."""
    return byte_bpe.digest(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.digest(table(spark, sf_dir, "documents"))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers in every document, and the corpus-wide counts of their id pairs."""
    return token_alignment.digest(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE, public_tokenizers.PATTERN)


@query("op12_centroid_clustering", centroid_clustering.oracle())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds around sixteen centroids, in integers."""
    return centroid_clustering.digest(table(spark, sf_dir, "embeddings"))


@query("op13_warc", warc.ORACLE)
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of every page, read back from an archive that stores each payload once."""
    return warc.digest(table(spark, sf_dir, "pages"))

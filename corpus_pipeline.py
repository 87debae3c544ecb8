"""From raw documents to token counts, in five stages; each works on all that the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import folioflow
from folioflow.llm import byte_bpe, decontaminate, line_dedup, simhash, toxicity
from folioflow.llm.common import kept, table
from folioflow.llm.queries import BYTE_RANKS

# Workers get the package's functions with the task, so that they need no copy of it.
cloudpickle.register_pickle_by_value(folioflow)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; every document stays, with its new length."""
    left = line_dedup.drop_lines(docs, line_dedup.line_bitmaps(docs))
    return left.withColumn("n_chars", F.length("text").cast("bigint"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return simhash.first_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents a twentieth of whose words, or more, stand in benchmark windows go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of what is left and the bytes that they decode to, as digests."""
    return byte_bpe.digest(docs, BYTE_RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", count_tokens),
]

# Scores, fingerprints and merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

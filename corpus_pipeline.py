"""Corpus pipeline over documents: quality rules, line dedup, near-dedup, pseudonyms, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns what the next one reads:
the columns of documents, or packed pieces at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.llm import line_dedup, minhash, packing, pii, quality_rules, queries
from attestor.llm.common import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, from every document."""
    return line_dedup.drop_duplicate_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return minhash.drop_near_duplicates(docs)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms, by the fixed key of the registered queries; a corpus of one's own takes a secret one."""
    return pii.pseudonymise(docs, key=queries.KEY).select(*(F.col(f"`{c}`") for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_copies),
    ("feistel_pii", privacy),
    ("kk_packing", packed),
]

#: Edit-distance classes, keyed pseudonyms and byte-pair ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

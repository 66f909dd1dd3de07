"""The registered queries of the training-data operators: query(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, embedding, fill_in_middle, heap_bpe, line_dedup, minhash, oracle, packing, pii, quality_model, quality_rules, spelling, warc
from .common import text_or_empty


#: A fixed key, for results that can be compared; real pseudonyms need a secret one.
KEY = "a fixed key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its remaining text, and how many lines it had and has."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split(text_or_empty(), "\n", -1)).alias("n_lines"))
    out = line_dedup.drop_duplicate_lines(docs)
    return out.withColumn("text_sha256", F.sha2(text_or_empty(), 256)).select("doc_id", "n_lines", "text_sha256", "text")


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def op3_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), key=KEY)


def op4_kk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return chat.preference_pairs(turns, chat.neighbours(turns))


def op6_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents")).drop("row")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle.transform(_table(spark, sf_dir, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_heap_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = heap_bpe.decode(heap_bpe.encode(_table(spark, sf_dir, "documents")))
    digests = F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), *digests)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.ORACLES)

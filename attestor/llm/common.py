"""What the operators share: intermediate tables, the workers' import path, sub-batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space and words of the contracts, as Java regular expressions.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

_ROOT = str(Path(__file__).resolve().parents[2])


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when the driver found it off PYTHONPATH (a cluster gets it by --py-files)."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [_ROOT, env.get("PYTHONPATH", "")]))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and Spark is local."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_key(name: str = "text") -> Column:
    """64-bit hash of a text: with doc_id it tells rows of a repeated doc_id apart."""
    return F.xxhash64(text_or_empty(name))


def chunks(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose sizes sum to about `most`; a larger item gets a range of its own."""
    start, total, end = 0, 0, 0
    for end, n in enumerate(sizes, 1):
        total += n
        if total >= most:
            yield start, end
            start, total = end, 0
    if start < end:
        yield start, end


#: Parts that the rows of one key are dealt to where a key may hold a large part of a table.
PARTS = 8


def spread_join(many: DataFrame, few: DataFrame, key: str, by: Column, how: str = "inner") -> DataFrame:
    """many joined with few on key; rows of one key are dealt to PARTS tasks by a hash of `by`, each row of few goes to all.

    few has one row a key and is the smaller side by far; `by` tells rows of one key apart. _part is added to many and dropped.
    """
    dealt = many.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(PARTS)).cast("int"))
    copies = few.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return dealt.join(copies, [key, "_part"], how).drop("_part")


def carried(docs: DataFrame) -> Column:
    """All columns of docs as one struct, so that no name of theirs can clash with one of ours."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))

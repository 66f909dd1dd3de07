"""The folder that driver and executors share, for tables that a job writes once and reads more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir; in a temporary folder where Spark is local and the setting is absent."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys over as many tasks as a shuffle has, cores at least: for rows that are few bytes in a file but dear to work on.

    The number is given, so adaptive execution doesn't merge the parts by their bytes.
    """
    session = df.sparkSession
    return df.repartition(max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism), *keys)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: made once, and still there when an executor is lost."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

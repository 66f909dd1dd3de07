"""A table laid out by a hash of its key, of which each batch rewrites the buckets that it changes, once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Buckets of a table, for its whole life. Their numbers are the only thing that the driver reads.
BUCKETS = 16
#: Marks a row whose key has gone; a bucket of such rows alone tells that it is empty now.
GONE = "_gone"


def _versions(spark: SparkSession, path: str, before: int | None) -> dict[int, int]:
    """bucket -> the newest batch that wrote it, of those before a given one."""
    try:
        told = spark.read.schema("bucket int, batch long").parquet(f"{path}/versions/*")
    except AnalysisException:  # nothing is there yet
        return {}
    told = told if before is None else told.where(F.col("batch") < before)
    return {r.bucket: r.batch for r in told.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()}


def read(spark: SparkSession, path: str, schema: StructType, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
    """The table as the last batch left it, or as it was before a batch; only some buckets, if asked. No batch: no rows."""
    found = _versions(spark, path, before)
    at = [f"{path}/rows/{b}/_bucket={k}" for k, b in found.items() if buckets is None or k in buckets]
    whole = StructType([f for f in schema.fields if f.name != GONE]).add(GONE, "boolean")
    rows = spark.read.schema(whole).parquet(*at) if at else spark.createDataFrame([], whole)
    return rows.where(f"not {GONE}").drop(GONE)


def merge(changes: DataFrame, path: str, batch: int, key: Sequence[str], fold: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS) -> None:
    """Fold changes (rows and GONE) into the table: fold(old rows, changes) gives the new rows of the changed buckets.

    Old rows are those of the batches before this one, so a batch that is merged again, after a failure or by a repeated
    delivery, leaves the same table. Buckets without a change are neither read nor written.
    """
    spark = changes.sparkSession
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    touched = sorted(r[0] for r in changes.select(bucket).distinct().collect())  # `buckets` rows at most
    if not touched:
        return
    old = read(spark, path, changes.schema, batch, touched).withColumn(GONE, F.lit(False))
    rows = fold(old, changes).select(*changes.columns).withColumn("_bucket", bucket)
    rows.repartition(len(touched), "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/rows/{batch}")
    # the batch counts from here on
    spark.createDataFrame([(b, batch) for b in touched], "bucket int, batch long").coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/{batch}")

"""Sources and sinks: id batches, reference subsets, snapshots, documents, feeds, XML."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import stored

FETCH_LOG = "company string, url string, status int, attempts int, redirects array<string>, error string, sha256 string, bytes long, elapsed_ms long, at timestamp"


def parse_id_lines(lines: DataFrame, id_regex: str = r"^\d{9}$") -> tuple[DataFrame, DataFrame]:
    """IO1 over (pos, line): ids(pos, id) with the first occurrence of each, rejects(pos, line, reason).

    A line is a JSON object with the number under one of three names, or text whose first comma-separated column it is.
    """
    json = F.coalesce(*(F.get_json_object("line", f"$.{k}") for k in ("organisation_number", "organisasjonsnummer", "org")))
    raw = F.when(F.trim("line").startswith("{"), json).otherwise(F.split(F.trim("line"), ",")[0])
    rows = lines.where(F.trim("line") != "").withColumn("id", F.regexp_replace(F.coalesce(raw, F.lit("")), r"\D", ""))
    rows = rows.withColumn("ok", F.col("id").rlike(id_regex))
    rows = rows.withColumn("n", F.when(F.col("ok"), F.row_number().over(W.partitionBy("id").orderBy("pos"))))
    bad = rows.where("not ok or n > 1").select("pos", "line", F.when(~F.col("ok"), F.lit("invalid")).otherwise(F.lit("duplicate")).alias("reason"))
    return rows.where("n = 1").select("pos", "id"), bad


def read_id_batch(spark: SparkSession, path: str, id_regex: str = r"^\d{9}$") -> tuple[DataFrame, DataFrame]:
    """IO1 over a file; the order of a file's lines is that of its splits."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
    return parse_id_lines(lines, id_regex)


def load_reference_subset(ref: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """IO2: rows of a large reference whose key is wanted; Spark broadcasts the ids while they are small."""
    return ref.join(ids.select(F.col("id").alias(key)).distinct(), key, "left_semi")


#: Ranges of ids that a converted reference is asked for; the driver sees their ends only.
RANGES = 64


def convert_reference(ref: DataFrame, path: str, key: str, row_group_bytes: int = 16 << 20) -> None:
    """IO2, once: a reference that can't be split or searched, as Parquet sorted by its key.

    Every file and row group holds one range of keys, told by its statistics, with a Bloom filter for single keys. Rows
    without a key are left out, as no id can ask for them.
    """
    ranged = ref.where(F.col(key).isNotNull()).repartitionByRange(key).sortWithinPartitions(key)
    ranged.write.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", row_group_bytes).parquet(path)


def load_converted_subset(ref: DataFrame, ids: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """IO2 over a converted reference: the same rows as load_reference_subset, but only row groups that may hold an id are read.

    The ids are cut into a fixed number of ranges by Spark; their ends become a filter of the scan, equality where a range has one
    id. The semi-join decides. No ids give no rows.
    """
    wanted = ids.select(F.col("id").alias(key)).where(F.col(key).isNotNull()).distinct()
    part = wanted.repartitionByRange(ranges, key).groupBy(F.spark_partition_id()).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    ends = part.select("lo", "hi").collect()  # `ranges` rows at most
    inside = [F.col(key) == r.lo if r.lo == r.hi else F.col(key).between(r.lo, r.hi) for r in sorted(ends)]
    return ref.where(reduce(or_, inside, F.lit(False))).join(wanted, key, "left_semi")


def latest_documents(lines: DataFrame, key: str) -> DataFrame:
    """IO3 over (pos, line): the last good JSON line per key as (key, doc); lines without the key are left out."""
    rows = lines.withColumn("doc", F.when(F.trim("line").startswith("{"), F.col("line"))).withColumn("key", F.get_json_object("doc", f"$.{key}"))
    rows = rows.where("key is not null and key <> ''")
    return rows.groupBy("key").agg(F.max_by("doc", "pos").alias("doc"))


def load_latest_documents(spark: SparkSession, path: str, key: str) -> DataFrame:
    """IO3 over a path; a missing one gives no rows."""
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], "key string, doc string")
    lines = lines.select(F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
    return latest_documents(lines, key)


def snapshot_store(bodies: DataFrame, existing: DataFrame | None = None, with_body: bool = False) -> DataFrame:
    """IO4: one row per distinct body(kind, path): sha256, kind, path with extension, of the first path; known hashes left out."""
    more = [F.any_value(F.col("body").cast("string")).alias("body")] if with_body else []
    out = bodies.withColumn("sha256", F.sha2(F.col("body").cast("binary"), 256))
    out = out.groupBy("sha256").agg(F.min(F.struct("path", "kind")).alias("f"), F.count("*").alias("copies"), *more)
    ext = F.expr("case f.kind when 'json' then 'json' when 'html' then 'html' when 'xml' then 'xml' else 'txt' end")
    out = out.select("sha256", F.col("f.kind").alias("kind"), F.col("f.path").alias("first_path"), F.concat("sha256", F.lit("."), ext).alias("stored_as"), "copies", *(["body"] if with_body else []))
    return out if existing is None else out.join(existing.select("sha256"), "sha256", "left_anti")


#: Hex digits of a hash that name its partition of the store; bits and hash functions of a partition's Bloom filter, 32,768 bits a row.
PREFIX, BLOOM_BITS, BLOOM_HASHES = 2, 1 << 20, 4
_BITMAP = 32_768


def _bits(hashes: DataFrame) -> DataFrame:
    """(prefix, sha256, word, bit): where each hash stands in its partition's filter."""
    at = F.array(*(F.pmod(F.xxhash64("sha256", F.lit(i)), F.lit(BLOOM_BITS)) for i in range(BLOOM_HASHES)))
    return hashes.select("prefix", "sha256", F.explode(at).alias("p")).select("prefix", "sha256", F.expr(f"p div {_BITMAP}").alias("word"), (F.col("p") % _BITMAP).alias("bit"))


class SnapshotStore:
    """IO4, batch by batch: bodies by their hash under a path, laid out by the first digits of the hash, with a Bloom filter each.

    A batch asks the filters first. Hashes that no filter knows are new without a look at the store; only the partitions of
    the others are read. A batch that is added again replaces what it wrote, so it may be repeated after a failure.
    """

    ROWS = "sha256 string, kind string, first_path string, stored_as string, copies long, body string, prefix string, batch long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str, before: int | None) -> DataFrame:
        try:
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException:  # nothing is there yet
            rows = self.spark.createDataFrame([], schema)
        return rows if before is None else rows.where(F.col("batch") < before)

    def rows(self, before: int | None = None) -> DataFrame:
        return self._read("rows", self.ROWS, before)

    def known(self, hashes: DataFrame, before: int) -> DataFrame:
        """sha256 of those (prefix, sha256) that the store had before a batch; reads the partitions that the filters name."""
        filters = self._read("filters", "word long, bits binary, prefix string, batch long", before)
        filters = filters.groupBy("prefix", "word").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        byte = F.conv(F.hex(F.substring(F.col("bits"), F.expr("cast(bit div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
        set_ = F.expr("shiftright(byte, cast(bit % 8 as int)) & 1")
        asked = _bits(hashes).join(filters, ["prefix", "word"]).withColumn("byte", byte).where(set_ == 1)
        maybe = stored(asked.groupBy("prefix", "sha256").agg(F.count("*").alias("n")).where(F.col("n") == BLOOM_HASHES).select("prefix", "sha256"), "maybe")
        prefixes = [r.prefix for r in maybe.select("prefix").distinct().collect()]  # 16 ** PREFIX at most
        return maybe.join(self.rows(before).where(F.col("prefix").isin(prefixes)).select("prefix", "sha256"), ["prefix", "sha256"], "left_semi").select("sha256")

    def add(self, bodies: DataFrame, batch: int) -> DataFrame:
        """The rows that a batch of bodies(body, kind, path) adds, written; null bodies have no hash and are left out."""
        rows = snapshot_store(bodies.where("body is not null"), with_body=True).withColumn("prefix", F.left("sha256", F.lit(PREFIX)))
        rows = stored(rows, "snapshot-batch")
        new = rows.join(self.known(rows.select("prefix", "sha256"), batch), "sha256", "left_anti")
        # no `batch=` folder stands under rows until the batch is whole: the writer commits at its end
        new.repartition("prefix").write.mode("overwrite").partitionBy("prefix").parquet(f"{self.path}/rows/batch={batch}")
        added = self.rows().where(F.col("batch") == batch)
        bits = _bits(added.select("prefix", "sha256")).groupBy("prefix", "word").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
        bits.write.mode("overwrite").partitionBy("prefix").parquet(f"{self.path}/filters/batch={batch}")
        return added


def ordered_profiles(profile: DataFrame, ids: DataFrame, partitions: int | None = None) -> DataFrame:
    """IO5: one document per input id, in input order, in as many ranges as the session shuffles to unless told otherwise; ids
    without a document stay."""
    out = ids.join(profile, ids["id"] == profile["entity_id"], "left").drop("entity_id")
    ranged = out.repartitionByRange(partitions, "pos") if partitions else out.repartitionByRange("pos")
    return ranged.sortWithinPartitions("pos")


def write_profiles(profile: DataFrame, ids: DataFrame, path: str, partitions: int | None = None) -> None:
    ordered_profiles(profile, ids, partitions).drop("pos").write.json(path)


def resume_todo(ids: DataFrame, done: DataFrame) -> DataFrame:
    """IO6: ids not finished yet."""
    return ids.join(done.select("id").distinct(), "id", "left_anti")


def fetch_log(spark: SparkSession, path: str) -> DataFrame:
    """IO7: the request log by its schema."""
    return spark.read.schema(FETCH_LOG).json(path)


def feed_source(df: DataFrame, days: int, ts: str = "seen", now: Column | None = None) -> DataFrame:
    """IO8: feed events of the last `days` days before now, by default before the newest event. Works on streams if now is given."""
    if now is None:
        newest = df.agg(F.max(ts).alias("_now"))
        return df.crossJoin(F.broadcast(newest)).where(F.col(ts) >= F.col("_now") - F.expr(f"interval {days} days")).drop("_now")
    return df.where(F.col(ts) >= now - F.expr(f"interval {days} days"))


def xml_items(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """IO9: sitemap or feed items by row tag, through Spark's XML source."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def compressed_export(df: DataFrame, path: str) -> None:
    """IO10: documents as gzipped JSON lines."""
    df.write.option("compression", "gzip").json(path)

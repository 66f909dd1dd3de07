"""Ranking, limits, set operations and sampling. Every order has a unique last column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], ts: str, tiebreak: str) -> DataFrame:
    """Newest row of each key by event time, the later arrival among equals; rows without a key go.

    An aggregate of one struct, not a window: a hot key is combined before it is shuffled.
    """
    rest = [c for c in df.columns if c not in key]
    df = df.where(" and ".join(f"{k} is not null" for k in key))
    return df.groupBy(*key).agg(F.max(F.struct(ts, tiebreak, *[c for c in rest if c not in (ts, tiebreak)])).alias("_r")).select(*key, *(F.col(f"_r.{c}") for c in rest))


def active_index(latest: DataFrame, fold: Column) -> DataFrame:
    """Active rows of W1 with their folded name."""
    return latest.where("status = 'ACTIVE'").withColumn("name_key", fold)


def first_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in discovery order."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_r")).select(*key, *(F.col(f"_r.{c}") for c in rest))


def top_n_per_entity(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows of each key; Spark prunes each partition to n of a key before the shuffle."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= n)


def period_trend(facts: DataFrame, flat: float = 0.5) -> DataFrame:
    """facts(entity_id, field, period, value) -> newest period of each against the one before it.

    trend: rose, fell or flat by at least half a per cent; to_loss and to_profit where the sign turned; from_zero; first.
    """
    w = W.partitionBy("entity_id", "field").orderBy("period")
    out = facts.withColumn("prior", F.lag("value").over(w)).withColumn("last", F.lead("period").over(w).isNull()).where("last")
    pct = F.when(F.col("prior") != 0, F.round(100 * (F.col("value") - F.col("prior")) / F.abs("prior"), 1))
    trend = (
        F.when(F.col("prior").isNull(), F.lit("first"))
        .when(F.col("prior") == 0, F.lit("from_zero"))
        .when((F.col("prior") > 0) & (F.col("value") < 0), F.lit("to_loss"))
        .when((F.col("prior") < 0) & (F.col("value") > 0), F.lit("to_profit"))
        .when(F.col("pct") >= flat, F.lit("rose"))
        .when(F.col("pct") <= -flat, F.lit("fell"))
        .otherwise(F.lit("flat"))
    )
    return out.withColumn("pct", pct).select("entity_id", "field", "period", "value", "prior", "pct", trend.alias("trend"))


def pick_site(verdicts: DataFrame, max_candidates: int = 4) -> DataFrame:
    """verdicts(entity_id, ord, url, status, n_words) -> the site of each entity, and how many candidates were read.

    The first max_candidates in order are read until one is exact. Without one the first review counts as ambiguous, if
    the name has two distinctive words at least.
    """
    w = W.partitionBy("entity_id").orderBy("ord")
    seen = verdicts.withColumn("i", F.row_number().over(w)).where(F.col("i") <= max_candidates)
    one = lambda status: F.min(F.when(F.col("status") == status, F.struct("i", "url")))
    out = seen.groupBy("entity_id").agg(one("exact").alias("e"), one("review").alias("r"), F.max("n_words").alias("n_words"), F.max("i").alias("n"))
    review = F.col("r").isNotNull() & (F.col("n_words") >= 2)
    return out.select(
        "entity_id",
        F.when(F.col("e").isNotNull(), F.col("e.url")).when(review, F.col("r.url")).alias("url"),
        F.when(F.col("e").isNotNull(), F.lit("available")).when(review, F.lit("ambiguous")).otherwise(F.lit("not_available")).alias("state"),
        F.coalesce(F.col("e.i"), F.col("n")).cast("long").alias("candidates_read"),
    )


def frontier_rank(links: DataFrame, kinds: Sequence[str], budget: int = 7) -> DataFrame:
    """links(site, url, kind, depth) -> the first `budget` of a site: the best of each kind, then the rest."""
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    links = links.withColumn("kind_rank", rank.cast("int")).withColumn("n", F.char_length("url"))
    order = ["depth", "n", "url"]
    # nothing beyond `budget` of a kind can be chosen; Spark cuts at the limit before it shuffles
    links = links.withColumn("i", F.row_number().over(W.partitionBy("site", "kind").orderBy(*order))).where(F.col("i") <= budget)
    links = links.withColumn("rank", F.row_number().over(W.partitionBy("site").orderBy((F.col("i") > 1).cast("int"), "kind_rank", *order)))
    return links.where(F.col("rank") <= budget).select("site", "rank", "kind", "url")


def newest_lastmod(urls: DataFrame, limit: int = 500) -> DataFrame:
    """urls(site, pos, url, lastmod) -> newest date among the first `limit` of a sitemap."""
    return urls.where(F.col("pos") <= limit).where("lastmod is not null").groupBy("site").agg(F.max("lastmod").alias("lastmod"), F.max_by("url", F.struct("lastmod", "url")).alias("url"))


def stable_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The same n rows for the same rows and seed, however they are partitioned; sorted by key."""
    return df.orderBy(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256), key).limit(n).orderBy(key)


def hash_split(df: DataFrame, key: str, cuts: tuple[int, int] = (60, 80)) -> DataFrame:
    """Development, validation or final by the first eight hex digits of the key's SHA-256, modulo 100."""
    bucket = F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 8), 16, 10).cast("long") % 100
    name = F.when(bucket < cuts[0], F.lit("development")).when(bucket < cuts[1], F.lit("validation")).otherwise(F.lit("final"))
    return df.withColumn("bucket", bucket).withColumn("split", name)


def added_removed(prev: DataFrame, cur: DataFrame, key: Sequence[str]) -> DataFrame:
    """S3: keys on one side only, with `side` added or removed."""
    p, c = prev.select(*key).distinct(), cur.select(*key).distinct()
    return c.join(p, list(key), "left_anti").withColumn("side", F.lit("added")).unionByName(p.join(c, list(key), "left_anti").withColumn("side", F.lit("removed")))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either set that the other lacks; one aggregate over both, not two anti-joins."""
    both = a.distinct().withColumn("_s", F.lit(1)).union(b.distinct().withColumn("_s", F.lit(2)))
    return both.groupBy(*a.columns).agg(F.sum("_s").alias("_s")).where("_s < 3").withColumn("side", F.when(F.col("_s") == 1, F.lit("left")).otherwise(F.lit("right"))).drop("_s")


def is_subset(a: Column, b: Column) -> Column:
    """Every element of a is in b."""
    return F.size(F.array_except(a, b)) == 0


def new_items(cur: Column, prev: Column) -> Column:
    """Elements of cur that prev lacks, in order, once each."""
    return F.array_except(cur, F.coalesce(prev, F.array().cast("array<string>")))

"""Structured Streaming jobs: latest events, counts, changes, deduplicated landings."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from ..operators.diff import diff_claims
from ..sources import versioned
from ..sources.versioned import BUCKETS

#: How rows are kept in state: JSON with all digits of their times.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class _Latest(StatefulProcessor):
    """The newest row of a key, by (at, tie); a timer at its event time lets it go when the watermark has passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.row = handle, handle.getValueState("row", "at bigint, tie bigint, row string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        old = None if (found := self.row.get()) is None else tuple(found)  # each call of the state is a message: no more than needed
        best = max(((r["_at"], r["_tie"], r["_row"]) for r in rows), key=lambda r: r[:2])
        if old is None or best[:2] > old[:2]:
            if old is not None:
                self.handle.deleteTimer(old[0] // 1000)
            self.row.update(best)
            self.handle.registerTimer(best[0] // 1000)
            yield Row(_key=key[0], _before=old and old[2], _after=best[2], _at=best[0])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        old = tuple(self.row.get())
        self.row.clear()
        yield Row(_key=key[0], _before=old[2], _after=None, _at=old[0])

    def close(self) -> None:
        pass


def latest_moves(stream: DataFrame, key: Sequence[str], ts: str, tiebreak: str, lookback: str = "60 days") -> DataFrame:
    """Every change of a key's latest row: (key columns, before, after), structs of the whole row, null for none.

    State is one row a key. A row that is older than its key's latest one, by ts and the whole number tiebreak, changes
    nothing, whenever it comes. Rows more than `lookback` behind the newest event are dropped as late, and a key whose latest row
    falls behind it goes: after is null then. Keys may be of any type; rows without ts or with a null key are dropped.
    """
    rows = stream.where(F.col(ts).isNotNull()).where(" and ".join(f"`{c}` is not null" for c in key))
    at, whole = F.unix_micros(F.col(ts).cast("timestamp")), F.struct(*stream.columns)
    rows = rows.select(F.to_json(F.struct(*key)).alias("_key"), F.col(ts).cast("timestamp").alias("_ts"), at.alias("_at"), F.coalesce(F.col(tiebreak).cast("long"), F.lit(0).cast("long")).alias("_tie"), F.to_json(whole, _JSON).alias("_row"))
    moves = rows.withWatermark("_ts", lookback).groupBy("_key").transformWithState(_Latest(), "_key string, _before string, _after string, _at long", "Update", "EventTime")
    kind = stream.schema
    parsed = {f"_{c}": F.from_json(F.col(f"_{c}"), kind, _JSON) for c in ("before", "after")}
    out = moves.select(*(p.alias(c[1:]) for c, p in parsed.items()))
    return out.select(*(F.coalesce(F.col(f"after.{c}"), F.col(f"before.{c}")).alias(c) for c in key), "before", "after")


def _job(moves: DataFrame, path: str, step: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Start the job over what there is. State lives in RocksDB, so it needn't fit in the executors' memory."""
    conf = moves.sparkSession.conf
    provider = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in conf.get(provider):
        conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def once(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    return _start(moves, path, once)


def _start(rows: DataFrame, path: str, step: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return rows.writeStream.outputMode("update").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(step).start()


def feed_latest_job(stream: DataFrame, path: str, key: Sequence[str], ts: str, tiebreak: str, lookback: str = "60 days", buckets: int = BUCKETS) -> StreamingQuery:
    """ST1: the latest row of each key within the lookback, as a table under path/table that each batch upserts.

    `versioned.read(spark, path/table, stream.schema)` is the answer, without any ranking. A batch rewrites only the buckets
    of keys that changed; one that runs again writes the same again.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*(F.col(f"after.{c}").alias(c) if c not in key else F.col(c) for c in stream.columns), F.col("after").isNull().alias(versioned.GONE))
        versioned.merge(rows, f"{path}/table", batch_id, key, lambda old, new: old.join(new, list(key), "left_anti").unionByName(new), buckets)

    return _job(latest_moves(stream, key, ts, tiebreak, lookback), path, step)


def active_counts_job(stream: DataFrame, path: str, key: Sequence[str], name: str, ts: str, tiebreak: str, lookback: str = "60 days", buckets: int = BUCKETS) -> StreamingQuery:
    """ST2: per name, how many keys' latest row is ACTIVE, as a table (name, n) under path/table; names without any go.

    Two stages: keyed state tells how each key's latest row moved; a move takes back what the row before counted for and adds
    what the new one counts for. Their sums a name are merged into the table, in the batch's own version of it.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        side = lambda c, n: F.struct(F.col(f"{c}.{name}").alias(name), F.when(F.col(f"{c}.status") == "ACTIVE", n).otherwise(0).cast("long").alias("n"))
        moved = batch.select(F.inline(F.array(side("before", -1), side("after", 1)))).where(F.col(name).isNotNull())
        moved = moved.groupBy(name).agg(F.sum("n").alias("n")).where("n <> 0")

        def fold(old: DataFrame, new: DataFrame) -> DataFrame:
            both = old.unionByName(new).groupBy(name).agg(F.sum("n").alias("n"))
            return both.withColumn(versioned.GONE, F.col("n") == 0)

        versioned.merge(moved.withColumn(versioned.GONE, F.lit(False)), f"{path}/table", batch_id, [name], fold, buckets)

    return _job(latest_moves(stream, key, ts, tiebreak, lookback), path, step)


CHANGES = "entity_id string, run long, field string, change_type string, previous_value string, current_value string"


def _compare(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames))
    known = json.loads(state.get[0]) if state.exists else None
    last = -1 if known is None else known["run"]
    out = []
    for run, part in sorted(rows.groupby("run"), key=lambda x: x[0]):
        if run <= last:  # delivered before
            continue
        now = dict(zip(part["field"], part["value"], strict=True))
        before = None if known is None else known["facts"]
        if before is not None:
            for f in sorted(before.keys() | now.keys()):
                if before.get(f) != now.get(f):
                    kind = "added" if f not in before else "removed" if f not in now else "changed"
                    out.append((key[0], int(run), f, kind, before.get(f), now.get(f)))
        known, last = {"run": int(run), "facts": now}, run
    if known is not None:
        state.update((json.dumps(known, sort_keys=True),))
    yield pd.DataFrame(out, columns=["entity_id", "run", "field", "change_type", "previous_value", "current_value"])


def change_stream(stream: DataFrame) -> DataFrame:
    """ST3, ST4: stream(entity_id, run, field, value), whole runs -> changes against the run before.

    The first run of an entity is its baseline. A run delivered again, or out of order after a later one, gives nothing.
    """
    return stream.groupBy("entity_id").applyInPandasWithState(_compare, CHANGES, "s string", "append", GroupStateTimeout.NoTimeout)


def _kept(spark: SparkSession, schema: StructType, paths: Sequence[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _limit(spark: SparkSession, path: str, batch: int, keep: str) -> Column | None:
    """The time that lies `keep` behind the newest row of all batches before this one; None before the first."""
    try:
        seen = spark.read.schema("batch long, at long").parquet(f"{path}/seen/*").where(F.col("batch") < batch).agg(F.max("at")).first()[0]
    except AnalysisException:  # nothing is there yet
        return None
    return None if seen is None else F.timestamp_micros(F.lit(seen)) - F.expr(f"interval {keep}")


def claim_change_job(stream: DataFrame, path: str, ts: str | None = None, keep: str = "400 days", buckets: int = BUCKETS) -> StreamingQuery:
    """ST3, ST4: the changes of a stream of claims (entity_id, run, ord, field, ...) by the rules of D, under path/changes, a folder a batch.

    An entity's first run is its baseline and gives nothing; a run that comes again, or after a later one, gives nothing. Several
    runs in a batch are told one after the other; a run has to come in one batch. With ts, the time of a run, entities whose newest
    run is more than `keep` behind the newest row of the batches before are forgotten, so that their next run is a baseline, and
    rows that are older are dropped as late.

    The claims of new runs are written once, under path/claims, a folder a batch, by buckets of their entity. What a batch rewrites
    is one short row an entity in the buckets that it touches: path/known has its newest run and the batch that brought it. So a batch
    finds the run before each of its own in the buckets of a few folders, by a join. diff_claims compares the two, each pair
    of runs an entity of its own. A batch that runs again overwrites its own folders, so nothing is told twice.
    """
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    index = StructType([StructField("entity_id", kinds["entity_id"]), StructField("run", LongType()), StructField("batch", LongType()), StructField("at", TimestampType())])
    held = StructType([*index.fields[:3], StructField("claim", stream.schema)])
    bucket = F.pmod(F.xxhash64("entity_id"), F.lit(buckets)).cast("int")
    pair = F.to_json(F.struct(F.col("entity_id").cast("string").alias("e"), F.col("run").cast("string").alias("r"))).alias("entity_id")
    rest = [F.col(f"claim.{c}").alias(c) for c in stream.columns if c not in ("entity_id", "run")]

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, here = batch.sparkSession, F.lit(batch_id).cast("long")
        at = F.col(ts) if ts else F.lit(None)
        rows = batch.select("entity_id", F.col("run").cast("long").alias("run"), here.alias("batch"), at.cast("timestamp").alias("at"), F.struct(*stream.columns).alias("claim")).where("entity_id is not null and run is not null")
        fresh = lambda df: df
        if ts:
            rows = rows.where("at is not null")
            limit = _limit(spark, path, batch_id, keep)
            rows.agg(here.alias("batch"), F.max(F.unix_micros("at")).alias("at")).write.mode("overwrite").parquet(f"{path}/seen/{batch_id}")
            if limit is not None:
                fresh = lambda df: df.where(F.col("at") >= limit)
        came = fresh(rows).groupBy("entity_id", "run").agg(F.max("at").alias("at")).persist()
        touched = sorted(r[0] for r in came.select(bucket).distinct().collect())  # `buckets` rows at most
        known = fresh(versioned.read(spark, f"{path}/known", index, batch_id, touched)).select("entity_id", F.struct("run", "batch", "at").alias("last"))
        # new runs, each with the run before it: of this batch, else the one that is known
        inside = F.lag("run").over(Window.partitionBy("entity_id").orderBy("run"))
        runs = came.hint("merge").join(known, "entity_id", "left").where("last is null or run > last.run")
        runs = runs.select("entity_id", "run", F.greatest("at", "last.at").alias("at"), F.coalesce(inside, "last.run").alias("before"), F.when(inside.isNotNull(), here).otherwise(F.col("last.batch")).alias("before_batch")).persist()
        try:
            new = fresh(rows).hint("merge").join(runs.select("entity_id", "run"), ["entity_id", "run"]).select(*held.names, bucket.alias("_bucket"))
            # a bucket is four tasks' work
            new.repartition(4 * max(len(touched), 1), "_bucket", F.pmod(F.hash("entity_id"), F.lit(4))).write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/claims/{batch_id}")
            pairs = runs.where("before is not null")
            folder = lambda df, b: [f"{path}/claims/{r[0]}/_bucket={r[1]}" for r in df.select(b, bucket).distinct().collect()]
            after = _kept(spark, held, folder(pairs, here)).hint("merge").join(pairs.select("entity_id", "run"), ["entity_id", "run"]).select(pair, *rest)
            earlier = pairs.select("entity_id", F.col("before").alias("run"), F.col("before_batch").alias("batch"), F.col("run").alias("later"))
            before = _kept(spark, held, folder(pairs, "before_batch")).hint("merge").join(earlier, ["entity_id", "run", "batch"]).drop("run").withColumnRenamed("later", "run").select(pair, *rest)
            changes = diff_claims(before, after)
            own = (F.get_json_object("entity_id", f"$.{k}").cast(kinds[c]).alias(c) for k, c in (("e", "entity_id"), ("r", "run")))
            changes.select(*own, *changes.columns[1:]).write.mode("overwrite").parquet(f"{path}/changes/_batch={batch_id}")
            newest = runs.groupBy("entity_id").agg(F.max("run").alias("run"), F.max("at").alias("at")).select("entity_id", "run", here.alias("batch"), "at", F.lit(False).alias(versioned.GONE))
            versioned.merge(newest, f"{path}/known", batch_id, ["entity_id"], lambda old, new: fresh(old).join(new, "entity_id", "left_anti").unionByName(new), buckets)
        finally:
            runs.unpersist()
            came.unpersist()

    return _start(stream, path, step)


def landing_dedupe(stream: DataFrame, ts: str | None = None, late: str = "60 days") -> DataFrame:
    """ST5: each body once, by its hash; with an event time the state of old hashes is let go."""
    out = stream.withColumn("sha256", F.sha2(F.col("body").cast("binary"), 256))
    if ts:
        return out.withWatermark(ts, late).dropDuplicatesWithinWatermark(["sha256"])
    return out.dropDuplicates(["sha256"])

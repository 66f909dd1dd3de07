"""Keyed state: restarts, late and repeated rows, rows that go, and the table that batches merge into."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest
from attestor.operators.diff import diff_claims
from attestor.sources import versioned
from attestor.streaming import feeds
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ADS = "uuid string, status string, name string, seen timestamp, n long"
DAY = datetime(2024, 3, 1)


def ad(uuid, status, name, day, n=0):
    return (uuid, status, name, DAY + timedelta(days=day, microseconds=n), n)


@pytest.fixture
def landing(spark, tmp_path):
    def land(rows, schema, job):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = job(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "job"))
        q.awaitTermination()

    # state is kept a partition; these streams are small
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield land
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_latest_rows_are_a_table(spark, landing, tmp_path):
    def land(*rows):
        landing(list(rows), ADS, lambda s, at: feeds.feed_latest_job(s, at, ["uuid"], "seen", "n", "60 days", buckets=3))
        return {r.uuid: (r.status, r.name, r.seen, r.n) for r in versioned.read(spark, str(tmp_path / "job" / "table"), spark.createDataFrame([], ADS).schema).collect()}

    a, b = ad("a", "ACTIVE", "x", 0, 1), ad("b", "ACTIVE", None, 30, 2)
    assert land(a, ad("a", "ACTIVE", "older", -1), b, (None, "ACTIVE", "x", DAY, 1), ("c", "ACTIVE", "x", None, 1)) == {"a": a[1:], "b": b[1:]}
    stopped = ad("a", "INACTIVE", "x", 2)
    assert land(stopped, ad("b", "ACTIVE", "late", 29)) == {"a": stopped[1:], "b": b[1:]}
    assert land(stopped, stopped) == {"a": stopped[1:], "b": b[1:]}  # delivered again
    new = ad("d", "ACTIVE", "y", 70)
    assert land(new) == {"b": b[1:], "d": new[1:]}  # a is 68 days old
    assert land(ad("a", "ACTIVE", "too late", 3)) == {"b": b[1:], "d": new[1:]}


def test_counts_take_back(spark, landing, tmp_path):
    def land(*rows):
        landing(list(rows), ADS, lambda s, at: feeds.active_counts_job(s, at, ["uuid"], "name", "seen", "n", "60 days", buckets=2))
        return {r.name: r.n for r in versioned.read(spark, str(tmp_path / "job" / "table"), StructType().add("name", "string").add("n", "long")).collect()}

    assert land(ad("a", "ACTIVE", "x", 0), ad("b", "ACTIVE", "x", 1), ad("c", "INACTIVE", "y", 1), ad("e", "ACTIVE", None, 1)) == {"x": 2}
    assert land(ad("a", "INACTIVE", "x", 3), ad("c", "ACTIVE", "y", 0)) == {"x": 1}  # c's flip is older than what is known
    assert land(ad("b", "ACTIVE", "y", 4)) == {"y": 1}  # x has gone, not become 0
    assert land(ad("a", "ACTIVE", "x", 62)) == {"x": 1, "y": 1}
    assert land(ad("z", "INACTIVE", "y", 70)) == {"x": 1}  # b fell behind the lookback


CLAIMS = "entity_id string, run long, ord int, field string, section string, value string, availability string, reporting_period string, note string, source string, observed string"


def run_of(entity, run, **values):
    return [(entity, run, i, f, "identity", v, "available" if v is not None else "not_available", None, None, None, f"2024-01-{run:02}") for i, (f, v) in enumerate(sorted(values.items()))]


@pytest.mark.parametrize("ts", [None, "observed"])
def test_changes_of_runs(spark, landing, tmp_path, ts):
    def land(*runs):
        landing([r for run in runs for r in run], CLAIMS, lambda s, at: feeds.claim_change_job(s, at, ts, "30 days"))
        try:
            return Counter((r.entity_id, r.run, r.field, r.change_type) for r in spark.read.parquet(str(tmp_path / "job" / "changes")).collect())
        except AnalysisException:
            return Counter()

    one, two = run_of("e", 1, legal_name="A", legal_form="AS"), run_of("e", 2, legal_name="B", legal_form="AS")
    assert land(one, run_of("f", 1, legal_name="F")) == Counter()
    told = Counter([("e", 2, "legal_name", "changed_name")])
    assert land(two, [(None, 1, *two[0][2:])]) == told
    assert land(two) == told and land(one) == told  # again, and late
    both = land(run_of("f", 3, legal_name="G"), run_of("f", 2, legal_name="F", legal_form="DA"), run_of("e", 3, legal_name="B", legal_form="DA"))
    want = told + Counter([("f", 3, "legal_name", "changed_name"), ("e", 3, "legal_form", "changed_legal_form")])
    assert both == want
    assert land(run_of("f", 9, legal_name="H", legal_form="AS")) - want == Counter([("f", 9, "legal_name", "changed_name")])
    # the same as between tables
    now = spark.createDataFrame(run_of("e", 3, legal_name="B", legal_form="DA"), CLAIMS).drop("run")
    assert [(r.field, r.change_type) for r in diff_claims(spark.createDataFrame(two, CLAIMS).drop("run"), now).collect()] == [("legal_form", "changed_legal_form")]


def test_entities_without_runs_are_forgotten(spark, landing, tmp_path):
    def land(*runs):
        landing([r for run in runs for r in run], CLAIMS, lambda s, at: feeds.claim_change_job(s, at, "observed", "5 days"))
        try:
            return Counter((r.entity_id, r.run) for r in spark.read.parquet(str(tmp_path / "job" / "changes")).collect())
        except AnalysisException:
            return Counter()

    assert land(run_of("e", 1, legal_name="A"), run_of("f", 1, legal_name="F")) == Counter()
    assert land(run_of("e", 10, legal_name="B")) == {("e", 10): 1}
    assert land(run_of("f", 11, legal_name="G")) == {("e", 10): 1}  # a baseline again
    assert land(run_of("f", 2, legal_name="H")) == {("e", 10): 1}  # late
    assert land(run_of("f", 12, legal_name="H")) == {("e", 10): 1, ("f", 12): 1}


def test_a_batch_merged_again_changes_nothing(spark, tmp_path):
    kind = StructType().add("k", "long").add("v", "long")
    path = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame([(*r, False) for r in rows], "k long, v long, _gone boolean")
    add = lambda old, new: old.unionByName(new).groupBy("k").agg(F.sum("v").alias("v")).withColumn("_gone", F.col("v") == 0)
    said = lambda before=None: {r.k: r.v for r in versioned.read(spark, path, kind, before).collect()}
    assert said() == {}
    versioned.merge(frame([(i, 1) for i in range(20)]), path, 0, ["k"], add, 4)
    for _ in range(2):
        versioned.merge(frame([(3, 5), (4, -1), (77, 2)]), path, 1, ["k"], add, 4)
        assert said() == {**{i: 1 for i in range(20) if i != 4}, 3: 6, 77: 2}
    versioned.merge(frame([]), path, 2, ["k"], add, 4)
    for _ in range(2):
        versioned.merge(frame([(k, -v) for k, v in said(3).items()]), path, 3, ["k"], add, 4)
        assert said() == {} and said(1) == {i: 1 for i in range(20)}


def test_claims_are_written_once_and_no_state_store_is_asked(spark, landing, tmp_path):
    jobs = []

    def land(*runs):
        landing([r for run in runs for r in run], CLAIMS, lambda s, at: jobs.append(feeds.claim_change_job(s, at, buckets=64)) or jobs[-1])
        assert [p["stateOperators"] for p in jobs[-1].recentProgress if p["stateOperators"]] == []
        at, n = tmp_path / "job", len(jobs) - 1
        claims = spark.read.schema("entity_id string").parquet(*map(str, (at / "claims" / str(n)).glob("_bucket=*"))) if list((at / "claims" / str(n)).glob("_bucket=*")) else None
        return Counter(r.entity_id for r in claims.collect()) if claims else Counter(), len(list((at / "known" / "rows" / str(n)).glob("_bucket=*")))

    claims, buckets = land(*(run_of(f"e{i}", 1, legal_name="A", legal_form="AS") for i in range(40)))
    assert claims == Counter({f"e{i}": 2 for i in range(40)}) and buckets > 8
    # a batch writes its own claims and the buckets of its own entities
    assert land(run_of("e7", 2, legal_name="B", legal_form="AS")) == (Counter({"e7": 2}), 1)
    assert land(run_of("e7", 2, legal_name="B", legal_form="AS")) == (Counter(), 0)
    assert [(r.entity_id, r.run, r.change_type) for r in spark.read.parquet(str(tmp_path / "job" / "changes")).collect()] == [("e7", 2, "changed_name")]

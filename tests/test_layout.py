"""What a scan reads: row groups of a converted reference, partitions of the snapshot store."""

from __future__ import annotations

import random

import pytest
from attestor.operators import diff
from attestor.sources import io


def rows_read(df):
    """Rows that the scans of Parquet gave, by the plan's metrics."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.nodeName().endswith("QueryStage"):
            node = node.plan()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_a_converted_reference_reads_what_the_ids_need(spark, tmp_path):
    rows = [(i, f"name {i}" * 20) for i in range(200_000)]
    random.Random(1).shuffle(rows)
    ref = spark.createDataFrame(rows, "key long, name string").union(spark.createDataFrame([(None, "no key")], "key long, name string"))
    path = str(tmp_path / "ref")
    io.convert_reference(ref, path, "key", row_group_bytes=1 << 18)
    got = {}
    for ids in ([], [77_777], [5, 6, 7, 150_000], list(range(1000, 9000)), list(range(0, 200_000, 11)), [-5, 10**9]):
        frame = spark.createDataFrame([(i,) for i in [*ids, *ids[:3], None]], "id long")
        out = io.load_converted_subset(spark.read.parquet(path), frame, "key")
        assert sorted(r.key for r in out.collect()) == sorted(i for i in ids if 0 <= i < 200_000)
        got[len(ids)] = rows_read(out.select("key"))
    assert got[0] == 0 and got[1] < 20_000 and got[4] < 60_000 and got[8000] < 60_000 and got[2] <= got[1]


def test_a_batch_reads_the_partitions_of_what_may_be_known(spark, tmp_path):
    store = io.SnapshotStore(spark, str(tmp_path / "store"))
    bodies = lambda ids: spark.createDataFrame([(f"body {i}", "html", f"p{i:05}") for i in ids] + [(None, "html", "x")], "body string, kind string, path string")
    assert store.add(bodies(range(3000)), 0).count() == 3000
    new = store.add(bodies([*range(5000, 5020), 7, 7, 8]), 1)
    assert sorted(r.body for r in new.collect()) == [f"body {i}" for i in range(5000, 5020)]
    assert store.add(bodies([*range(5000, 5020), 7, 7, 8]), 1).count() == 20 and store.rows().count() == 3020
    hashes = store.rows().where("body in ('body 7', 'body 8', 'body 5001')").select("prefix", "sha256")
    known = store.known(hashes, 1)
    assert known.count() == 2
    assert rows_read(known) < 200  # two partitions of 256, and the hashes themselves
    assert store.known(spark.createDataFrame([("00", "00" * 32)], "prefix string, sha256 string"), 2).count() == 0
    assert store.add(bodies([]), 2).count() == 0


@pytest.mark.parametrize("before", [0, 5])
def test_an_empty_store_knows_nothing(spark, tmp_path, before):
    store = io.SnapshotStore(spark, str(tmp_path / "none"))
    assert store.rows().count() == 0 and store.known(spark.createDataFrame([("ab", "ab")], "prefix string, sha256 string"), before).count() == 0


def test_saved_runs_meet_without_a_shuffle(spark, tmp_path):
    cols = "entity_id long, ord int, field string, section string, value string, availability string, reporting_period string, note string, source string, observed string"
    run = lambda n: spark.createDataFrame([(e, i, f, "identity", v, "available" if v else "failed", None, None, None, "2024") for e in range(50) for i, (f, v) in enumerate([("legal_name", f"N{e % n}"), ("role", '{"name":"A","role":"%d"}' % (e % n)), ("founded", None if e % n else "2001")])], cols)
    for name, n in (("run_a", 3), ("run_b", 5)):
        diff.save_run(run(n), name, str(tmp_path / name), buckets=4)
    joined = diff.joined_runs(spark.table("run_a"), spark.table("run_b"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    told = lambda df: sorted(map(str, df.drop("last_observed").collect()))
    assert told(diff.diff_runs(spark.table("run_a"), spark.table("run_b"))) == told(diff.diff_claims(run(3), run(5)))

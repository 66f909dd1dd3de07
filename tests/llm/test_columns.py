"""Columns of the caller's come back as they were, whatever their names: those that the operators use inside, dots, the same as results."""

from __future__ import annotations

import pytest

from attestor.llm import bpe, embedding, line_dedup, minhash, packing, pii, quality_model, quality_rules, warc

NAMES = (
    "_d", "_r", "_row", "_drop", "_lines", "_hit", "_found", "_rest", "_text", "_in", "_words", "_part", "d", "r", "row", "drop", "lines", "hit", "found", "rest",
    "own", "key", "id", "at", "pos", "kept", "n_words", "component_id", "set_id", "bands", "keep", "a.b", "n pii", "made",
)
GOOD = " ".join(["the house and the garden of a long street is in the town with many trees"] * 1 + [f"word{i} and" for i in range(60)])
TEXTS = [GOOD, GOOD, f"{GOOD}\nmail me at a.b@example.org on 2021-02-28", None, "", "short line\nshort line"]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, t, 7, *(f"{n}{i}" for n in NAMES)) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES))


def same(before, after):
    assert after.columns == before.columns
    had = {r[0]: tuple(r)[3:] for r in before.collect()}
    got = after.collect()
    assert got and all(tuple(r)[3:] == had[r[0]] for r in got)
    return {r[0]: r for r in got}


def test_line_dedup(frame):
    got = same(frame, line_dedup.drop_duplicate_lines(frame))
    assert {i: r.text for i, r in got.items()} == {0: GOOD, 1: "", 2: "mail me at a.b@example.org on 2021-02-28", 3: None, 4: "", 5: "short line"}
    assert got[1].n_chars == 0 and got[0].n_chars == 7


def test_near_duplicates(frame):
    assert same(frame, minhash.drop_near_duplicates(frame)).keys() == {0, 3, 4, 5}


def test_pseudonyms(frame):
    out = pii.pseudonymise(frame, key="k")
    got = same(frame, out.drop("n_pii"))
    assert out.columns == [*frame.columns, "n_pii"] and got[0].text == GOOD and "a.b@example.org" not in got[2].text and got[2].n_chars == len(got[2].text)
    assert {r.doc_id: r.n_pii for r in out.where("n_pii > 0").collect()} == {2: 2}


def test_rules(frame):
    assert same(frame, quality_rules.keep_good(frame)).keys() == {r.doc_id for r in quality_rules.quality_rules(frame).where("kept").collect()} == {0, 1, 2}


def test_operators_that_only_read(spark, frame):
    assert quality_model.score(frame, spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")).count() == len(TEXTS)
    assert bpe.round_trip(frame).count() == len(TEXTS) and packing.pack(frame).select("doc_id").distinct().count() == len(TEXTS)
    vectors = frame.selectExpr("doc_id as vec_id", "array(1.0D, doc_id) as embedding", "1 as label", *(f"`{n}`" for n in NAMES))
    assert embedding.near_duplicates(vectors).count() == len(TEXTS)
    pages = frame.selectExpr("doc_id as page_id", "'u' as url", "text as html", *(f"`{n}`" for n in NAMES))
    assert warc.archive(pages).count() == len(TEXTS)

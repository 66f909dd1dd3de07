"""Words one edit apart, against a loop over all edits of every word."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from attestor.llm import queries, spelling


def words_of(docs, shortest=6, rarest=5, dropped=199):
    count = Counter()
    for doc, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if dropped and h % dropped == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1 :]
            if len(w) >= shortest:
                count[w] += 1
    return {w: n for w, n in count.items() if n >= rarest}


def near(words):
    """word -> words one edit away, by putting a wildcard at and between all places."""
    holes, out = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)) if len(w) < 6000 else (0, 2999, 3000, 6999):  # where the long ones differ
            holes.setdefault((w[:i], w[i + 1 :]), set()).add(w)
            if (shorter := w[:i] + w[i + 1 :]) in out:
                out[w].add(shorter)
                out[shorter].add(w)
    for together in holes.values():
        for w in together:
            out[w] |= together - {w}
    return out


def plainly(words, times=5):
    others = near(words)
    form = {}
    for w, n in words.items():
        if others[w]:
            best = min(others[w], key=lambda o: (-words[o], o))
            if words[best] >= times * n:
                form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(others[w]), words[form[w]] if w in form else None))
    return out


def test_acceptor_is_minimal():
    words = sorted({"tap", "taps", "top", "tops", "stop", "stops"})
    a = spelling.Acceptor()
    start = a.add(words)
    assert len(a.arcs) == 7  # by hand: before anything, st or o, t; a or o; p, s or the end; the end
    todo, read = [(start, "")], []
    while todo:
        q, w = todo.pop()
        read += [w] * a.final[q]
        todo += [(r, w + c) for c, r in a.arcs[q].items()]
    assert sorted(read) == words
    assert a.add(words) == start and a.add([]) == a.add([])


@pytest.mark.parametrize("together", [10_000, 3])
def test_near_words(spark, monkeypatch, together):
    monkeypatch.setattr(spelling, "TOGETHER", together)
    rng = random.Random(together)
    words = {"".join(rng.choices("ab", k=rng.randint(6, 9))) for _ in range(250)} | {"".join(rng.choices("aéÿ", k=rng.randint(6, 7))) for _ in range(80)}
    words |= {"prefix" + "".join(rng.choices("abc", k=6)) for _ in range(200)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "x" * 7000, "x" * 7001, "x" * 3000 + "y" + "x" * 4000, "x" * 2999 + "y" + "x" * 4001}
    frame = spark.createDataFrame([(w,) for w in sorted(words)] + [(None,), ("aaaaaa",), ("short",), ("shor",)], "word string")
    got = Counter((r.a, r.b) for r in spelling.near_words(frame).collect())
    assert set(got.values()) == {1}
    assert {frozenset(p) for p in got} == {frozenset((w, o)) for w, others in near(words).items() for o in others}
    assert all(len(a) <= len(b) for a, b in got)


def test_variants_follow_forms(spark):
    rows = [("abcdef", 3000), ("abcdeg", 600), ("abcdgg", 100), ("abcggg", 20), ("bbcdef", 601), ("zzzzzz", 7), ("zzzzzy", 7), ("lonely", 5)]
    got = {tuple(r) for r in spelling.variants(spark.createDataFrame(rows, "word string, n int")).collect()}
    assert got == plainly(dict(rows))
    assert ("abcggg", "abcdgg", "abcdef", 20, 1, 100) in got and ("zzzzzz", None, "zzzzzz", 7, 1, None) in got
    assert spelling.variants(spark.createDataFrame([], "word string, n int")).count() == 0


def test_vocabulary(spark):
    texts = ["Straße Straßen × letter LETTER Élan-vital ÉLANVITAL x÷yzabc _letter9letters", None, "", "naïveté " * 30 + "word1word " * 9, "lettre letter\nletters" * 60, "a" * 900]
    docs = [(i % 40, t) for i in range(400) for t in texts] + [(None, texts[4])]
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n long, word string")
    got = {r.word: r.n for r in spelling.vocabulary(frame).collect()}
    assert got == words_of(docs) and any(w not in words_of(docs, dropped=0) for w in got)
    assert {r.word: r.n for r in spelling.vocabulary(frame, dropped=0, shortest=4, rarest=401).collect()} == words_of(docs, 4, 401, 0)
    assert spelling.spelling_variants(frame.limit(0)).count() == 0
    assert {tuple(r) for r in spelling.spelling_variants(frame).collect()} == plainly(words_of(docs))


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = [tuple(r) for r in queries.op12_spelling_variants(spark, sf_dir).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plainly(words_of(docs))
    assert any(r[1] for r in rows)

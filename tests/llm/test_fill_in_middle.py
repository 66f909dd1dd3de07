"""Texts cut at line ends, against plain string functions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
from attestor.llm import fill_in_middle as fim
from attestor.llm import queries

ODD = [
    None, "", "\n", "\n\n\n", "one line", "one line\n", "a\nb\nc", "a\nb\nc\n", "é\n日本語\n😀\n\u0085x y\n", "\r\n" * 9, "x<P>y\nz", "<S>", "a<M>", "<P\nS>\nx", "<\n<P\nM>",
    "\x0b\n\x8a\nਊ\n亊\n", "ab\n" * 50_000 + "end", "x" * 100_003, "\x00\n\x01",
]


def sha(t: str) -> str:
    return hashlib.sha256(t.encode()).hexdigest()


def plainly(doc, text, seed=7, rate=100, suffix_first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digest = len(units), sha(f"{seed}:{'' if doc is None else doc}")
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:i], units[i:j], units[j:]))
    if h4 % 100 < suffix_first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_marks():
    rng = np.random.default_rng(0)
    for size in (0, 1, 7, 8, 9, 63, 500):
        raw = rng.choice(np.array([9, 10, 11, 0x8A, 0xC3, 0x80, 0xBF, 0xFF, 0, 0x0A], np.uint8), size)
        for found, want in ((fim.line_ends(fim._words(raw)), raw == 10), (fim.continuations(fim._words(raw)), (raw & 0xC0) == 0x80)):
            marks = fim.Marks(found)
            assert marks.rank(np.arange(size + 1)).tolist() == [int(want[:i].sum()) for i in range(size + 1)]
            places = np.flatnonzero(want)
            assert marks.select(np.arange(len(places))).tolist() == places.tolist()


def test_transform(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choices("a\né<P", k=rng.randint(0, 60))) for _ in range(300)]
    rows = [(i, t, "spare") for i, t in enumerate(texts)] + [(5, "again\n5\n"), (5, "again\n5\n"), (None, "no\nid\nat all")]
    frame = spark.createDataFrame([(r[0], r[1], "spare") for r in rows], "doc_id long, text string, output string")
    for rate, suffix_first in ((100, 50), (40, 0), (0, 50), (100, 100)):
        out = fim.transform(frame, rate=rate, suffix_first=suffix_first).withColumn("again", fim.restored())
        got = Counter(tuple(r) for r in out.collect())
        assert got == Counter((r[0], *plainly(r[0], r[1], 7, rate, suffix_first), r[1] or "") for r in rows)
    assert fim.transform(frame.limit(0)).count() == 0


def test_long_batches_are_searched_in_parts(spark, monkeypatch):
    text = "line é\n" * 40
    monkeypatch.setattr(fim, "TOGETHER", 100)
    import pyarrow as pa

    ids = list(range(9))
    h = {f"h{i}": [d * 7919 * i for d in ids] for i in (1, 2, 3, 4)}
    batch = pa.RecordBatch.from_pydict({"doc_id": ids, "text": [text[:17 * i] for i in ids], **h})
    got = [r for b in fim._run(iter([batch, batch.slice(3)]), 100, 50) for r in b.to_pylist()]
    assert [r["doc_id"] for r in got] == ids + ids[3:] and got[3:9] == got[9:]
    for r in got:
        units = text[: 17 * r["doc_id"]].splitlines(keepends=True)
        assert r["n"] == len(units)


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op11_fill_in_middle(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got.keys() == {d.doc_id for d in docs}
    for d in docs:
        n, form, p, m, output = plainly(d.doc_id, d.text)
        r = got[d.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, p, m, sha(output), sha(d.text or ""))
    assert {r.form for r in got.values()} >= {"spm", "psm"}

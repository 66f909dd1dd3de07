"""Line, document and embedding dedup against brute force, and their edge cases."""

from __future__ import annotations

import math
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestor.llm import embedding, line_dedup, linking, minhash


def components(ids, pairs):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def docs():
    """Random texts, a large group of near copies of different likeness, exact copies, repeats, and odd ones."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    base = rng.choices(vocab, k=120)
    texts = [" ".join(rng.choices(vocab, k=rng.randint(1, 80))) for _ in range(60)]
    for _ in range(220):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
            copy[rng.randrange(len(copy))] = rng.choice(vocab)
        texts.append(" ".join(copy))
    texts += ["A b c", "a B\tc", "a b", "", None, "   ", "to to to to to of of of of of", "É é", "x" * 20000]
    return list(enumerate(texts))


def test_minhash_against_brute_force(spark, docs):
    frame = spark.createDataFrame([(i, t, 1, "c") for i, t in docs], "doc_id long, text string, set_id int, component_id string").repartition(5)
    got = {r.doc_id: r for r in minhash.near_duplicates(frame).collect()}
    sets = {i: shingles(t) for i, t in docs}
    pairs = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = components(sets, pairs)
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.kept for i, r in got.items()} == {i: i == c for i, c in want.items()}
    kept = minhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {i for i, c in want.items() if i == c}


def test_minhash_nulls_repeats_and_nothing(spark):
    kind = "doc_id long, text string"
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, "z"), (9, None)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, kind)).collect()), key=repr)
    assert got == sorted([(None, 7, False), (7, 7, True), (7, 7, True), (None, None, True), (9, 9, True)], key=repr)
    assert minhash.near_duplicates(spark.createDataFrame([], kind)).count() == 0


def test_super_minhash_estimates_jaccard():
    rng = np.random.default_rng(3)
    for n in (10, 300, 3000):
        u = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        a, b = np.unique(u[:n]), np.unique(np.concatenate([u[: n * 6 // 7], u[n : n + n // 7]]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = minhash.super_minhash([a, b], 512)
        assert abs((s[0] == s[1]).mean() - true) < 0.09
        assert (s[0] >> np.uint64(32)).max() < 512


def test_connected(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 300), (300, 200), (5, 5), (7, 8)] + [(1000, k) for k in range(1001, 1200)]
    got = {r.id: r.root for r in linking.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {x for e in edges for x in e}
    assert got == components(ids, edges)
    assert linking.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edit_distance_and_probes():
    rng = random.Random(1)
    for _ in range(4000):
        a = "".join(rng.choices("ab" if rng.random() < 0.5 else "abcdefgh", k=rng.choice([1, 2, 5, 40, 63, 64, 65, 130])))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            i, kind = rng.randrange(len(b) + 1), rng.random()
            if kind < 0.4:
                b.insert(i, rng.choice("abz"))
            elif i < len(b):
                b[i : i + 1] = [] if kind < 0.7 else [rng.choice("abz")]
        b = "".join(b)
        near = line_dedup._table(a, b) <= line_dedup.EDITS
        assert near == line_dedup.within(a, b)
        if near and min(len(a), len(b)) >= line_dedup.MIN_CHARS:
            assert set(line_dedup.line_keys(a)) & set(line_dedup.line_keys(b))


def test_marks_and_probes_of_any_number_of_edits(monkeypatch):
    """Marks of lines in reach fit, in numpy and by slices; the segments find every pair whatever the edits are."""
    rng = random.Random(9)

    def edited(a, n):
        b = list(a)
        for _ in range(n):
            i, kind = rng.randrange(len(b) + 1), rng.random()
            if kind < 0.5:
                b.insert(i, rng.choice("abé日"))
            elif i < len(b):
                b[i : i + 1] = [] if kind < 0.75 else [rng.choice("abz")]
        return "".join(b)

    lines = ["".join(rng.choices("abcdef é日 ABC", k=rng.randint(0, 200))) for _ in range(500)]
    near = [edited(x, rng.randint(0, line_dedup.EDITS)) for x in lines]
    a, b = line_dedup.marks(lines), line_dedup.marks(near)
    assert line_dedup.Edits().fit(a, b).all()
    assert not line_dedup.Edits().fit(a, line_dedup.marks([x + "qvw" for x in lines])).any()
    monkeypatch.setattr(line_dedup, "COUNTED", 7)
    assert (line_dedup.marks(lines) == a).all() and len(line_dedup.marks([])) == 0
    for edits in (1, 2, 3, 4):
        for x in lines:
            y = edited(x, edits)
            if min(len(x), len(y)) > edits:
                assert set(line_dedup.line_keys(x, edits)) & set(line_dedup.line_keys(y, edits)), (edits, x, y)


def test_lines_against_brute_force(spark):
    rng = random.Random(2)
    line = lambda n=60: "".join(rng.choices("abcdefghij ", k=n))
    stock, texts = [line(rng.randint(41, 90)) for _ in range(12)], []
    hot = line(70)
    for i in range(80):
        rows = [rng.choice(stock) if rng.random() < 0.4 else line() for _ in range(rng.randint(1, 6))]
        rows = [r[:9] + "#" + r[10:] if rng.random() < 0.3 else r for r in rows]
        texts.append("\n".join([*rows, hot[: 20 + i % 30] + "é" + hot[21 + i % 30 :], "short"]))
    texts += ["", None, hot, hot + "\n" + hot, "\n\n"]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame([(i, t, -1, "k") for i, t in docs], "doc_id long, text string, n_chars long, keys string")
    got = {r.doc_id: r for r in line_dedup.drop_duplicate_lines(frame).collect()}
    lines = sorted({x for _, t in docs for x in (t or "").split("\n") if len(x) >= line_dedup.MIN_CHARS})
    klass = components(lines, [(a, b) for a, b in combinations(lines, 2) if abs(len(a) - len(b)) <= 2 and line_dedup._table(a, b) <= 2])
    seen = set()
    for i, t in docs:
        if t is None:
            assert got[i].text is None
            continue
        keep = []
        for x in t.split("\n"):
            if len(x) < line_dedup.MIN_CHARS or klass[x] not in seen:
                keep.append(x)
            seen.add(klass.get(x))
        want = "\n".join(keep)
        assert got[i].text == want and got[i].n_chars in (-1, len(want)) and got[i].keys == "k"


def test_lines_of_every_length_against_brute_force(spark):
    """No line is too short: those of 3 characters or more join by edits, those below by equality, blank ones not at all."""
    rng = random.Random(7)
    alphabet = "".join(map(chr, range(0x4E00, 0x4E00 + 400)))
    line = lambda n: "".join(rng.choices(alphabet, k=n))
    stock, texts = [line(n) for n in [*range(1, 45), 1, 2, 2, 3, 3, 4, 4, 5]], []
    for _ in range(60):
        rows = []
        for _ in range(rng.randint(1, 8)):
            x = list(rng.choice(stock))
            for _ in range(rng.choice([0, 0, 1, 2, 3]) if len(x) > 2 else 0):
                i = rng.randrange(len(x))
                x[i : i + 1] = rng.choice([[], [rng.choice(alphabet)], [x[i], rng.choice(alphabet)]]) if len(x) > 2 else x[i : i + 1]
            rows.append("".join(x))
        texts.append("\n".join([*rows, rng.choice(["", "  ", "\t"]), "}"]))
    long = line(41)
    texts += ["Erheed. Titionly.\nErheed. Titionly.", long[:39], long, "ab\nab\nax"]
    found = sorted({x for t in texts for x in t.split("\n") if x.strip()})
    klass = components(found, [(a, b) for a, b in combinations(found, 2) if min(len(a), len(b)) >= 3 and abs(len(a) - len(b)) <= 2 and line_dedup._table(a, b) <= 2])
    got = {r.doc_id: r.text for r in line_dedup.drop_duplicate_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    seen, want = set(), {}
    for i, t in enumerate(texts):
        keep = []
        for x in t.split("\n"):
            if x not in klass or klass[x] not in seen:
                keep.append(x)
            seen.add(klass.get(x))
        want[i] = "\n".join(keep)
    assert got == want
    assert got[60] == "Erheed. Titionly." and (got[61], got[62]) == (long[:39], "") and got[63] == "ab\nax"


def test_lines_nulls_repeats_and_nothing(spark):
    a, b = "first line of the text, long enough to count", "second line of the text, long enough to count"
    rows = [(None, a), (1, f"{a}\n{b}"), (1, f"{a}\n{b}"), (2, b)]
    got = sorted((str(r.doc_id), r.text) for r in line_dedup.drop_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("1", b), ("1", b), ("2", ""), ("None", a)]
    assert line_dedup.drop_duplicate_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 32))
    x[100:330] = x[0] + 0.02 * np.linalg.norm(x[0]) * rng.standard_normal((230, 32)) / np.sqrt(32) * rng.uniform(0, 8, (230, 1))
    x[330:350] = x[1] * 3.0
    x[350:360] = x[2]
    label = rng.integers(0, 2, 400)
    label[100:330] = label[0] = 1
    rows = [(i, v.tolist(), int(k), "x") for i, (v, k) in enumerate(zip(x, label, strict=True))]
    rows += [(400, None, 1, "x"), (401, [0.0] * 32, 1, "x"), (402, [float("nan")] * 32, 1, "x"), (403, x[0].tolist(), None, "x"), (404, [None] * 32, 1, "x"), (405, [1.0, 2.0], 1, "x"), (406, [], 1, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, component string").repartition(3)
    got = {r.vec_id: r for r in embedding.near_duplicates(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    links = {i: int(near[i].sum()) for i in range(400)} | {i: 0 for i in range(400, 407)}
    total = sum(links.values())
    assert all(got[i].n_links <= n for i, n in links.items())  # none below the threshold
    assert sum(got[i].n_links for i in links) >= 0.99 * total > 10_000
    want = components(range(407), np.argwhere(np.triu(near)).tolist())
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i for i, r in got.items() if r.kept} == {i for i, c in want.items() if i == c}
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding.near_duplicates(none).count() == 0


def test_embedding_plan_of_any_size():
    """The limits keep the recall at the threshold; blocks stay of one size whatever the number of vectors."""
    p = math.erf(embedding.WINDOW / math.sqrt(2 - 2 * embedding.COSINE) / math.sqrt(2))
    near, far = (embedding.same_cell(math.sqrt(d)) for d in (2 - 2 * embedding.COSINE, 2))
    for n in (0, 1, 100, 10_000, 1_000_000, 30_000_000, 140_000_000, 10**10, 10**12):
        width, groups, need = embedding.plan(n)
        reached = sum(math.comb(embedding.COUNTED, k) * p**k * (1 - p) ** (embedding.COUNTED - k) for k in range(need, embedding.COUNTED + 1))
        assert reached > 1 - embedding.MISS and (1 - near**width) ** groups <= embedding.MISS
        assert n * far**width <= embedding.BLOCK


def test_window_collisions():
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 50):
        p = rng.standard_normal((n, 5)).round(1 if n == 50 else 9) + 0.013 * np.arange(5)
        want = (np.abs(p[:, None] - p[None]) <= embedding.WINDOW + 1e-12).sum(axis=2)
        i, j = embedding.collided(p, 3)
        assert {*zip(i.tolist(), j.tolist(), strict=True)} == {(a, b) for a in range(n) for b in range(a + 1, n) if want[a, b] >= 3} or n == 50
        near, far = ((np.abs(p[:, None] - p[None]) <= embedding.WINDOW + e).sum(axis=2) for e in (-1e-9, 1e-9))
        found = {*zip(i.tolist(), j.tolist(), strict=True)}
        assert {(a, b) for a, b in zip(*np.nonzero(np.triu(near >= 3, 1)), strict=True)} <= found <= {(a, b) for a, b in zip(*np.nonzero(np.triu(far >= 3, 1)), strict=True)}


def test_embedding_recall_of_planted_pairs(spark):
    """6,000 vectors of one label, 1,000 pairs planted just above the threshold and 500 just below it."""
    rng = np.random.default_rng(8)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(rng.standard_normal((4500, 48)))
    aim = np.concatenate([rng.uniform(0.9801, 0.984, 1000), rng.uniform(0.97, 0.9799, 500)])[:, None]
    off = rng.standard_normal((1500, 48))
    off = unit(off - (off * x[:1500]).sum(axis=1, keepdims=True) * x[:1500])
    x = np.concatenate([x, aim * x[:1500] + np.sqrt(1 - aim**2) * off])
    assert embedding.plan(len(x))[0] > 2
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding.near_duplicates(frame).collect()}
    assert sum(got[4500 + i].component_id == i for i in range(1000)) >= 990
    assert all(got[5500 + i].n_links == 0 for i in range(500))


def test_embedding_repeats_and_null_ids(spark):
    rows = [(5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (None, [2.0, 4.0], 1), (3, [1.0, 2.0], 2)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()), key=repr)
    assert got == sorted([(5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False), (3, 0, 3, True)], key=repr)


def test_many_lines_share_a_segment(spark):
    """A crowded bucket: one frame, counters in it; every pair that links is found."""
    rows = [(i, f"the same opening of a line that many share {i:04d} and its end") for i in range(300)]
    got = line_dedup.drop_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.where(F.col("text") != "").count() == 1  # 0000 to 0299 are linked over neighbours

"""Every stage on what its predecessor kept, held against the plain meaning of the stage."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import corpus_pipeline
import numpy as np
import public_tokenizers
from attestor.llm import line_dedup, minhash, packing, queries
from attestor.llm.common import materialize
from test_dedup import components, shingles
from test_texts import brute_counts, pseudonym
from tokenizers import Tokenizer


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, cols = docs.collect(), docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "minhash_near_dedup", "feistel_pii", "kk_packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        assert docs.columns == cols
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[i] == t for i, t in kept["quality_rules"].items()) and len(kept["quality_rules"]) < len(texts)
    assert kept["line_dedup"].keys() == kept["quality_rules"].keys()
    lines = Counter(x for t in kept["line_dedup"].values() for x in t.split("\n") if len(x) >= 40)
    assert max(lines.values()) == 1
    sets = {i: minhash.shingle_set(t) for i, t in kept["minhash_near_dedup"].items()}
    full = [s for s in sets.values() if len(s)]
    assert len({s.tobytes() for s in full}) == len(full)
    private = re.compile(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}")
    found = {m for t in kept["minhash_near_dedup"].values() for m in private.findall(t)}
    assert not [m for m in found if any(m in t for t in kept["feistel_pii"].values())]
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    want = {i: len(packing.document_ids(t or "")) // 4 for i, t in kept["feistel_pii"].items()}
    got = Counter()
    for r in pieces:
        got[r.doc_id] += r.length
    assert dict(got) == want


def test_run_against_brute_force(spark, tmp_path):
    """All five stages on a small corpus, each by plain loops over what the one before it left."""
    rng = random.Random(21)
    words = "the of and to in is that it for on with as was house garden street river mountain winter summer water letter number answer".split()
    line = lambda: " ".join(rng.choices(words, k=rng.randint(8, 16)))
    stock = [line() for _ in range(6)]
    texts = []
    for i in range(45):
        rows = [line() for _ in range(rng.randint(6, 9))] + [x[:5] + "q" + x[6:] if rng.random() < 0.5 else x for x in rng.sample(stock, 2)]
        rng.shuffle(rows)
        if i % 3 == 0:
            rows.append(f"mail user{i}x@mail.example.com or pay 4111 1111 1111 1111 by 2021-02-{1 + i % 28:02d} nr {i}")
        texts.append("\n".join(rows))
    for i in range(8):  # near copies that no line dedup takes whole: every line is edited in three places or more
        texts.append("\n".join(" ".join([f"w{i}x{k}", *x.split(), f"end{i}{k}"]) for k, x in enumerate(texts[i].split("\n"))))
    texts += ["too short", "", None, "### $$$ " * 60, texts[3]]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"file://{tmp_path}/documents.parquet")
    stages = corpus_pipeline.STAGES
    frame = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    # rules: the base by counting, the verdict of the rest is the operator's own (SQL holds it elsewhere)
    good = {r.doc_id: r.text for r in stages[0][1](spark, frame, "").collect()}
    failed = {i for i, t in docs if (c := brute_counts(t))[0] < 50 or 100 * c[4] > 50 * c[0]}
    assert not failed & good.keys() and len(good) >= 45
    # lines
    found = sorted({x for t in good.values() for x in t.split("\n") if x.strip()})
    klass = components(found, [(a, b) for a, b in combinations(found, 2) if abs(len(a) - len(b)) <= 2 and line_dedup.within(a, b)])
    seen, kept = set(), {}
    for i in sorted(good):
        rows = []
        for x in good[i].split("\n"):
            if x not in klass or klass[x] not in seen:
                rows.append(x)
            seen.add(klass.get(x))
        kept[i] = "\n".join(rows)
    assert kept != good
    # near copies
    sets = {i: shingles(t) for i, t in kept.items()}
    root = components(sets, [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])])
    kept = {i: t for i, t in kept.items() if root[i] == i}
    # pseudonyms
    for kind, pattern in (("email", r"user\d+x@mail\.example\.com"), ("card", "4111 1111 1111 1111"), ("%Y-%m-%d", r"2021-\d\d-\d\d")):
        kept = {i: re.sub(pattern, lambda m, k=kind: pseudonym(k, m[0], queries.KEY), t) for i, t in kept.items()}
    # packing
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in kept.items()}
    assert {r.doc_id for r in pieces} == ids.keys()
    for i, want in ids.items():
        at = 0
        for r in sorted((r for r in pieces if r.doc_id == i), key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(want[at : at + r.length], "<u4").tobytes()) and r.doc_tokens == len(want)
            at += r.length
        assert at == len(want)

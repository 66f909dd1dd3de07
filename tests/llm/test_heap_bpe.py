"""Ids and decoded texts as the `tokenizers` library has them."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter

import public_tokenizers
import pytest
from attestor.llm import heap_bpe, queries
from tokenizers import Tokenizer

ODD = [
    None, "", " ", "a  b \n c\t d ", "  x", "\n\n y's  ", "a" * 3000, "ab" * 900, "日本語テキスト" * 60, "\x1c a \x1cb", "a \u0085 b", "x <|endoftext|> y", "<|endoftext|><|endoftext|>",
    "<|endoftext", "\x00\x01 é" * 50, "don't WE'LL 12345 ---===", "😀👍🏽 ‍", "acgt" * 2000,
]


@pytest.fixture(scope="module")
def theirs():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def ours():
    return heap_bpe.HeapBpe()


def ids_of(bpe, text):
    import numpy as np

    return np.frombuffer(bpe.encode(text), "<i4").tolist()


def test_random_texts(ours, theirs):
    rng = random.Random(5)
    for alphabet in ("ab ", "abcdefgh'", "the \n\t", "é日😀 x", "ACGT", "0123456789.,-"):
        for _ in range(200):
            t = "".join(rng.choices(alphabet, k=rng.randint(0, 120)))
            want = theirs.encode(t, add_special_tokens=False).ids
            assert ids_of(ours, t) == want
            assert ours.decode(want) == theirs.decode(want, skip_special_tokens=False)


def test_decode_of_any_ids(ours, theirs):
    rng = random.Random(6)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 30))]
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)
    assert ours.decode([99999]) == ""


def test_what_a_worker_remembers_is_bounded(ours, theirs, monkeypatch):
    monkeypatch.setattr(heap_bpe, "REMEMBERED", 30)
    monkeypatch.setattr(heap_bpe, "LONGEST", 12)
    bpe, rng = heap_bpe.HeapBpe(), random.Random(7)
    for _ in range(40):
        t = " ".join("".join(rng.choices("abcde", k=rng.randint(1, 20))) for _ in range(20))
        assert ids_of(bpe, t) == theirs.encode(t, add_special_tokens=False).ids
        assert all(len(d) <= 30 for kept in (bpe.pieces, bpe.matches) for d in (kept, kept.old))


def test_one_long_match(ours, theirs):
    """A match of half a million letters takes n log n."""
    rng = random.Random(8)
    t = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=500_000))
    start = time.time()
    assert ids_of(ours, t) == theirs.encode(t, add_special_tokens=False).ids
    assert time.time() - start < 60


def test_operators(spark, theirs):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(3, ODD[3], "x"), (3, "other", "x"), (None, "no id", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = heap_bpe.encode(frame)
    got = Counter((r.doc_id, tuple(r.ids), r.text) for r in heap_bpe.decode(coded).collect())
    assert got == Counter((i, tuple(theirs.encode(t or "", add_special_tokens=False).ids), t or "") for i, t, _ in rows)
    assert heap_bpe.decode(heap_bpe.encode(frame.limit(0))).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [0, None, 99999])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in heap_bpe.decode(odd).collect()} == {1: "", 2: "", 3: "!"}


def test_query(spark, sf_dir, theirs):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {tuple(r) for r in queries.op13_heap_bpe(spark, sf_dir).collect()}
    want = set()
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = theirs.encode(d.text or "", add_special_tokens=False).ids
        want.add((d.doc_id, len(ids), sha(",".join(map(str, ids))), sha(theirs.decode(ids, skip_special_tokens=False))))
    assert got == want


def test_packing_encodes_whole_texts_as_the_library_does():
    from attestor.llm import packing

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a  b", " ", "a \n b", "   x", "å båt\U0001f600", "one <|endoftext|> two", "x" * 5000):
        raw = packing.document_ids(text)
        assert [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)] == [*library.encode(text, add_special_tokens=False).ids, packing.EOS]
    assert not hasattr(packing, "_ids")  # no table of pieces grows in a worker

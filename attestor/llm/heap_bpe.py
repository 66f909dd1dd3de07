"""BPE as the `tokenizers` files state it: merges from a priority queue over a linked list of symbols."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, ship, text_or_empty
from .tokens import VOCABULARY, added, pieces

#: Pieces of text, and as many matches, that a worker remembers, in two generations each; longer ones are not remembered.
REMEMBERED, LONGEST = 200_000, 256
_NONE = 1 << 30
#: Characters of text whose ids leave a worker together.
TOGETHER = 4_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in kept} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)}


class Recent(dict):
    """Ids of what was met lately: two generations of a bounded size, so that frequent keys outlive rare ones."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        if (ids := self.old.get(key)) is None:
            ids = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids


class _Strings(dict):
    """The bytes of each id; none of an unknown one."""

    def __missing__(self, key: int) -> bytes:
        return b""


class HeapBpe:
    """Merge table and vocabulary of one file, and the ids of the pieces met lately."""

    def __init__(self, path: str | None = None):
        with open(path or public_tokenizers.path(f"{VOCABULARY}.json")) as f:
            model = json.load(f)["model"]
        vocab, letters = model["vocab"], byte_letters()
        self.first = [0] * 256
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        self.ranks = {vocab[left] << 20 | vocab[right]: rank for rank, (left, right) in enumerate(model["merges"])}
        self.merged = [vocab[left + right] for left, right in model["merges"]]
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.added, self.special = added(path)
        self.bytes = _Strings({i: bytes(letters[c] for c in token) for token, i in vocab.items()} | {i: token.encode() for token, i in self.special.items()})
        self.pieces, self.matches = Recent(self._piece), Recent(self._match)

    def word(self, raw: bytes) -> list[int]:
        """The ids of one match of the pattern.

        The queue holds rank and place of the left symbol of neighbours that merge, least rank and then leftmost first. An
        entry is stale when the pair at its place has another rank by now, or none.
        """
        ids = [self.first[b] for b in raw]
        n = len(ids)
        if n < 2:
            return ids
        rank, merged = self.ranks.get, self.merged
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        ranks = [rank(a << 20 | b, _NONE) for a, b in pairwise(ids)] + [_NONE]
        queue = [r << 32 | i for i, r in enumerate(ranks) if r != _NONE]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            r, i = entry >> 32, entry & 0xFFFFFFFF
            if ranks[i] != r:
                continue
            j = after[i]
            ids[i] = token = merged[r]
            after[i] = k = after[j]
            ranks[j] = ranks[i] = _NONE
            if k >= 0:
                before[k] = i
                ranks[i] = r = rank(token << 20 | ids[k], _NONE)
                if r != _NONE:
                    heappush(queue, r << 32 | i)
            if (h := before[i]) >= 0:
                ranks[h] = r = rank(ids[h] << 20 | token, _NONE)
                if r != _NONE:
                    heappush(queue, r << 32 | h)
        out, i = [], 0
        while i >= 0:
            out.append(ids[i])
            i = after[i]
        return out

    def _match(self, match: str) -> bytes:
        """The ids of a match as little-endian 32-bit numbers."""
        return np.array(self.word(match.encode("utf-8", "surrogatepass")), "<i4").tobytes()

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.matches.__getitem__, self.split.findall(piece)))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text; tokens that the file adds are taken out before anything else."""
        parts = self.added.split(text)
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([self.special[part]], "<i4").tobytes())
            elif part:
                out += map(self.pieces.__getitem__, pieces(part))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings of the ids, joined; unknown ids are left out, broken UTF-8 becomes the replacement sign."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(1)
def _bpe(path: str | None) -> HeapBpe:
    return HeapBpe(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    bpe = _bpe(path)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for lo, hi in chunks(map(len, texts), TOGETHER):
            raw = [bpe.encode(t) if t else b"" for t in texts[lo:hi]]
            ends = np.zeros(len(raw) + 1, np.int32)
            np.cumsum([len(r) // 4 for r in raw], out=ends[1:])
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), ids], ["doc_id", "ids"])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row of docs, without special tokens but for those that its text spells.

    Null and empty texts have no ids. Each row stands by itself, so null and repeated doc_ids and repeated texts pass
    through; extra columns are not read. A match of the pattern takes time n log n, however long; distinct pieces are
    encoded once while a worker remembers them. `path` names a `tokenizers` file on the workers.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").alias("doc_id"), text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(partial(_encode, path=path), f"doc_id {kind}, ids array<int>")


def _decode(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    bpe = _bpe(path)
    for batch in batches:
        sizes = batch.column("ids").value_lengths().fill_null(0).to_pylist()
        for lo, hi in chunks(sizes, TOGETHER // 4):
            part, at, texts = batch.slice(lo, hi - lo), 0, []
            ids = part.column("ids").flatten().to_numpy(zero_copy_only=False).tolist()
            for n in sizes[lo:hi]:
                texts.append(bpe.decode(ids[at : at + n]))
                at += n
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text) of (doc_id, ids): the text that the ids stand for. Null and empty ids give an empty text."""
    ship(coded.sparkSession)
    coded = coded.select(F.col("doc_id").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.mapInArrow(partial(_decode, path=path), f"doc_id {kind}, ids array<int>, text string")

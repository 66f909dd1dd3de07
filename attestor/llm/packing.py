"""Sequence packing by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_or_empty
from .tokens import added, encoding

WINDOW, EOS = 2048, 1
#: Windows a group, and tokens left free in each for the imbalance.
WINDOWS, SLACK = 48, 5
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


_END = np.array([EOS], "<u4").tobytes()


def _plain_ids(text: str) -> bytes:
    """The ids of a text as little-endian 32-bit bytes; tiktoken gives them as an array, without a Python number an id."""
    return encoding().encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def document_ids(text: str) -> bytes:
    """The ids of a text and the end id. Added tokens of the `tokenizers` file count as such where a text spells them."""
    if not text:
        return _END
    pattern, ids = added()
    parts = pattern.split(text)
    if len(parts) == 1:
        return _plain_ids(text) + _END
    out = [np.array([ids[p]], "<u4").tobytes() if k % 2 else _plain_ids(p) for k, p in enumerate(parts) if p]
    return b"".join(out) + _END


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: items by index, dealt to so many windows of nearly equal sums.

    Each item starts as a partial partition of its own: one window holds it, the others nothing. The two partitions of
    largest spread are merged again and again, the fullest window of one with the emptiest of the other.
    """
    heap = []
    for i, n in enumerate(sizes):
        heap.append((-n, i, [0] * (windows - 1) + [n], [[] for _ in range(windows - 1)] + [[i]]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, sums, held = heapq.heappop(heap)
        _, _, others, more = heapq.heappop(heap)
        merged = sorted(((a + b, x, y) for a, b, x, y in zip(sums, reversed(others), held, reversed(more), strict=True)), key=lambda m: m[0])
        low = merged[0][0]  # only differences matter from here on
        heapq.heappush(heap, (low - merged[-1][0], i, [m[0] - low for m in merged], [m[1] + m[2] if m[2] else m[1] for m in merged]))
    return heap[0][3] if heap else [[] for _ in range(windows)]


def pack_group(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Windows of at most `window` tokens: as few as the sum allows, one more each time a window overflows."""
    count = max(1, -(-sum(sizes) // window))
    while True:
        out = differencing(sizes, count)
        if all(sum(sizes[i] for i in w) <= window for w in out):
            return [w for w in out if w]
        count += 1


def cut(n: int) -> list[int]:
    """Sizes of the pieces of a rest of n tokens: nearly all of it, and two small fillers that even the windows out."""
    if n <= 16:
        return [n]
    filler = max(8, n * 6 // 100)
    return [n - filler, filler - filler // 2, filler // 2]


class _Packer:
    """Fills windows from a stream of documents, a bounded group at a time."""

    def __init__(self, first: int):
        self.sequence, self.rows, self.group, self.total = first, [], [], 0

    def add(self, doc: int | None, ids: bytes) -> None:
        n, at = len(ids) // 4, 0
        while n - at >= WINDOW:  # a window that one document fills
            self._put([(doc, at, WINDOW, zlib.crc32(ids[4 * at : 4 * (at + WINDOW)]), n)])
            at += WINDOW
        room = WINDOWS * (WINDOW - SLACK)
        for size in cut(n - at) if n > at else ():
            while size:
                take = min(size, room - self.total)
                self.group.append((doc, at, take, zlib.crc32(ids[4 * at : 4 * (at + take)]), n))
                self.total, at, size = self.total + take, at + take, size - take
                if self.total == room:
                    self.flush()

    def flush(self) -> None:
        for window in pack_group([p[2] for p in self.group]) if self.group else ():
            self._put([self.group[i] for i in window])
        self.group, self.total = [], 0

    def _put(self, window: list[tuple]) -> None:
        offset = 0
        for doc, start, length, crc, n in window:
            self.rows.append((doc, start, length, crc, n, self.sequence, offset))
            offset += length
        self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) or [()] * len(_SCHEMA)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA, strict=True)], schema=_SCHEMA)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = _Packer(TaskContext.get().partitionId() << 40)
    for batch in batches:
        for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
            packer.add(doc, document_ids(text))
            if len(packer.rows) >= 20_000:
                yield packer.batch()
    packer.flush()
    yield packer.batch()


def pack(docs: DataFrame) -> DataFrame:
    """Pieces of every document, as (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document is its byte-level BPE ids and an end id; null and empty texts are the end id alone. Windows that one long
    document fills are sequences at once; the rests are cut into a few pieces and packed in groups of 48 windows by
    Karmarkar-Karp differencing, within the task that reads them, so nothing is shuffled. Only the last group of a task
    is short. sequence_id is unique, not gapless: the task's number comes first. Null and repeated doc_ids are packed as
    other rows are; extra columns are not read.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return docs.mapInArrow(_run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

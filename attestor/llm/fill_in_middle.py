"""Fill-in-the-middle transformation: texts cut at line ends, which are found eight bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, ship, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Percentages: of texts that are transformed, and of these the suffix-first ones.
RATE, SUFFIX_FIRST = 100, 50
#: Bytes that are searched together; a longer text is searched by itself.
TOGETHER = 16_000_000

_HIGH, _LOW = np.uint64(0x8080808080808080), np.uint64(0x7F7F7F7F7F7F7F7F)
_NEWLINES = np.uint64(0x0A0A0A0A0A0A0A0A)
_ONE, _THREE, _SEVEN, _EIGHT = (np.uint64(i) for i in (1, 3, 7, 8))


def _words(raw: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, the last one filled up with zeros, and a word of zeros behind them."""
    out = np.zeros(len(raw) // 8 + 2, "<u8")
    out.view(np.uint8)[: len(raw)] = raw
    return out


def line_ends(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed. No carry crosses a byte, so the marks are exact."""
    x = words ^ _NEWLINES
    return ~(((x & _LOW) + _LOW) | x) & _HIGH


def continuations(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte 10xxxxxx, the second to last bytes of a code point."""
    return words & ~(words << _ONE) & _HIGH


class Marks:
    """Marked bytes of a run of words: how many stand before a place, and where the k-th is."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, place: np.ndarray) -> np.ndarray:
        word = place >> 3
        below = (_ONE << ((place & 7).astype(np.uint64) << _THREE)) - _ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Places of the marks with so many before them: the word by its cumulative count, then the byte within it."""
        word = np.searchsorted(self.before, k, "right") - 1
        rest, m = k - self.before[word], self.marks[word]
        for i in range(7):
            m = np.where(rest > i, m & (m - _ONE), m)
        return (word << 3) + (np.bitwise_count((m & (~m + _ONE)) - _ONE) >> 3).astype(np.int64)


def cut(raw: np.ndarray, offsets: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """Texts raw[offsets[i]:offsets[i + 1]] with hashes h[0], h[1] -> lines, ends of prefix and middle, their code points."""
    words = _words(raw)
    lines, more = Marks(line_ends(words)), Marks(continuations(words))
    start, end = offsets[:-1], offsets[1:]
    first = lines.rank(start)
    full = lines.rank(end) - first
    open_ = (end > start) & (raw[np.maximum(end - 1, 0)] != 10) if len(raw) else np.zeros(len(start), bool)
    n = full + open_
    one, two = h[0] % (n + 1), h[1] % (n + 1)

    def place(k: np.ndarray) -> np.ndarray:
        out = np.where(k > full, end, start)
        inside = (k > 0) & (k <= full)
        out[inside] = lines.select(first[inside] + k[inside] - 1) + 1
        return out

    a, b = place(np.minimum(one, two)), place(np.maximum(one, two))
    skipped = [more.rank(x) for x in (start, a, b)]
    return n, a, b, a - start - (skipped[1] - skipped[0]), b - a - (skipped[2] - skipped[1])


def _run(batches: Iterator[pa.RecordBatch], rate: int, suffix_first: int) -> Iterator[pa.RecordBatch]:
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        h = np.stack([batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)])
        for lo, hi in chunks(np.diff(places).tolist(), TOGETHER):
            raw = data[places[lo] : places[hi]]
            offsets = places[lo : hi + 1] - places[lo]
            n, a, b, before, within = cut(raw, offsets, h[:2, lo:hi])
            plain = (np.diff(offsets) == 0) | (h[2, lo:hi] % 100 >= rate)
            last = h[3, lo:hi] % 100 < suffix_first
            forms, out = [], []
            for i, (x, y) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                text = raw[x:y].tobytes()
                if plain[i] or any(mark in text for mark in marks):
                    plain[i] = True
                    forms.append("plain")
                    out.append(text)
                    continue
                j, k = a[i] - x, b[i] - x
                forms.append("spm" if last[i] else "psm")
                out.append(b"".join((s, text[k:], p, text[:j], m, text[j:k]) if last[i] else (p, text[:j], s, text[k:], m, text[j:k])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    pa.array(n),
                    pa.array(forms),
                    pa.array(before, mask=plain),
                    pa.array(within, mask=plain),
                    pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(batch.schema.field("text").type),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of docs: its text as prefix, suffix and middle.

    A text is n lines, the last with or without its line feed. Two hashes of seed and doc_id cut it after some lines, two
    more choose the `rate` percent of texts that are transformed and the `suffix_first` percent of these whose suffix comes
    first (form spm, else psm). Null and empty texts, texts that spell a marker and the others stay as they are (form
    plain, no counts). Each row stands by itself: nothing is shuffled, and any number of rows may share a doc_id or a
    text. A null doc_id is hashed as an empty one; extra columns are not read. Texts are searched as a batch of UTF-8 in
    64-bit words, so time and memory follow the bytes, however they are dealt to lines and texts.
    """
    ship(docs.sparkSession)
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    docs = docs.select(F.col("doc_id").alias("doc_id"), text_or_empty().alias("text"), digest.alias("_digest"))
    hashes = [F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *hashes).mapInArrow(
        partial(_run, rate=rate, suffix_first=suffix_first),
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output and its form stand for. No transformed text spells a marker, so the three are found at once."""
    part = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(F.col(form) == "psm", F.concat(part[1], part[3], part[2]))
        .when(F.col(form) == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(F.col(output))
    )

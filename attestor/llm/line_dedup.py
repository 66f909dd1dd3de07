"""Near-duplicate lines by segment-partition edit join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, chunks, materialize, row_key, ship, spread_join
from .linking import Matcher, link

#: Edits between two lines that still count as one, and the characters below which they could rewrite a whole line: each of
#: the segments needs one. Shorter lines repeat only what equals them.
EDITS = 2
MIN_CHARS = EDITS + 1
#: White space of the contracts (common.SPACE): a line of nothing else has no word and no part.
_BLANK = " \t\n\v\f\r"
_WORD = (1 << 64) - 1
#: A mark is the parity of a line's characters in so many classes, and above it the line's length modulo the rest of 64 bits.
CLASSES = 54
_PARITY, _LENGTHS = (1 << CLASSES) - 1, 1 << (64 - CLASSES)
#: Lines whose keys a task remembers having given out already.
GIVEN = 200_000


@lru_cache(65536)
def segment_size(n: int, edits: int = EDITS) -> int:
    """Characters of each of the edits + 1 segments of a line of n: the largest of a growing row of sizes that fits so often.

    The row grows by a fifth, so lines of similar lengths have segments of one size and share keys.
    """
    size = 1
    while (larger := max(size + 1, size * 6 // 5)) * (edits + 1) <= n:
        size = larger
    return size


@lru_cache(65536)
def probes(n: int, edits: int = EDITS) -> list[tuple[int, int, int]]:
    """(start, end, seed) of a line's own segments and of the substrings that can equal a segment of a line in reach.

    The segments of the shorter line of a pair lie one after another: the first half from the start, the others up to
    the end. At most `edits` edits leave one of edits + 1 segments untouched; one with i segments on the nearer side is shifted
    by i places at most, for more edits there leave fewer for the other side, where another segment is untouched then.
    """
    out = set()
    for size in {segment_size(m, edits) for m in range(max(edits + 1, n - edits), n + 1)}:
        for i in range(edits + 1):
            at = i * size if 2 * i <= edits else n - (edits + 1 - i) * size
            shift = min(i, edits - i)
            out |= {(s, s + size, size * (edits + 1) + i) for s in range(max(0, at - shift), min(n - size, at + shift) + 1)}
    return sorted(out)


def line_keys(line: str, edits: int = EDITS) -> list[int]:
    digest, found = xxhash.xxh3_64_intdigest, probes(len(line), edits)
    if line.isascii():
        raw = line.encode()
        return [digest(raw[s:e], seed) - (1 << 63) for s, e, seed in found]
    return [digest(line[s:e].encode("utf-8", "surrogatepass"), seed) - (1 << 63) for s, e, seed in found]


#: Characters that are counted together at most; a longer line is counted in slices.
COUNTED = 1_000_000


def marks(lines: list[str]) -> np.ndarray:
    """The mark of each line. An edit changes the parity of two classes at most, and the length by one."""
    wide = lambda text: np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) % CLASSES
    size = np.array([len(x) for x in lines], np.int64)
    odd = np.zeros((len(lines), CLASSES), np.uint64)
    for lo, hi in chunks(size, COUNTED):
        if hi == lo + 1:
            for at in range(0, len(lines[lo]), COUNTED):
                odd[lo] += np.bincount(wide(lines[lo][at : at + COUNTED]), minlength=CLASSES).astype(np.uint64)
        else:
            place = np.repeat(np.arange(hi - lo, dtype=np.int64) * CLASSES, size[lo:hi]) + wide("".join(lines[lo:hi]))
            odd[lo:hi] = np.bincount(place, minlength=(hi - lo) * CLASSES).reshape(-1, CLASSES)
    parity = ((odd & np.uint64(1)) << np.arange(CLASSES, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return (parity | (size.astype(np.uint64) << np.uint64(CLASSES))).view(np.int64)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether the edit distance is at most `edits` (under 32): bit-parallel columns, one 64-bit word along the diagonal."""
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    same = _shared(a, b)
    a, b = a[same:], b[same:]
    same = _shared(a[::-1], b[::-1])
    a, b = a[: len(a) - same], b[: len(b) - same]
    if len(a) < len(b):
        a, b = b, a
    if len(b) <= edits:
        return max(len(a), len(b)) <= edits or _table(a, b) <= edits
    up, down, cost, edge = _WORD << (63 - edits) & _WORD, 0, edits, 1 << 62
    for j, c in enumerate(b):
        found, bit = 0, 1 << (63 - 2 * edits + max(0, edits - j))
        for x in a[max(0, j - edits) : j + edits + 1]:
            if x == c:
                found |= bit
            bit <<= 1
        same = ((((found & up) + up) ^ up) | found | down) & _WORD
        right, left = (down | ~(same | up)) & _WORD, same & up
        if j < len(a) - edits:
            cost += not same >> 63
            if cost > 2 * edits:
                return False
        else:
            cost += bool(right & edge) - bool(left & edge)
            edge >>= 1
        up, down = (left | ~(same >> 1 | right)) & _WORD, same >> 1 & right
    return cost <= edits


def _table(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


class Edits(Matcher):
    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = a.view(np.uint64), b.view(np.uint64)
        gap = (x >> np.uint64(CLASSES)) - (y >> np.uint64(CLASSES)) + np.uint64(EDITS) & np.uint64(_LENGTHS - 1)
        return (gap <= 2 * EDITS) & (np.bitwise_count((x ^ y) & np.uint64(_PARITY)) <= 2 * EDITS)

    def linked(self, a: str, b: str) -> bool:
        return within(a, b)


def _fits(x: str, y: str) -> Column:
    """Edits.fit as SQL."""
    gap = f"pmod(shiftrightunsigned({x}, {CLASSES}) - shiftrightunsigned({y}, {CLASSES}) + {EDITS}, {_LENGTHS})"
    return F.expr(f"{gap} <= {2 * EDITS} and bit_count(({x} ^ {y}) & {_PARITY}L) <= {2 * EDITS}")


_LINES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("pos", pa.int32()), ("id", pa.int64()), ("mark", pa.int64()), ("keys", pa.list_(pa.int64()))])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line with a word: its hash, place, mark and keys; no keys below MIN_CHARS, nor where this task gave them lately."""
    given: set[int] = set()
    rows: list[tuple] = []
    texts: list[str] = []
    held = 0

    def out() -> pa.RecordBatch:
        doc, row, pos, ids, keys = zip(*rows, strict=True) if rows else ((),) * 5
        made = (doc, row, pos, ids, marks(texts) if texts else (), keys)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, _LINES, strict=True)], schema=_LINES)

    for batch in batches:
        for doc, row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text")), strict=True):
            for pos, line in enumerate((text or "").split("\n")):
                if line.strip(_BLANK):
                    h = xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)
                    new = len(line) >= MIN_CHARS and h not in given
                    if new:
                        if len(given) >= GIVEN:
                            given.clear()
                        given.add(h)
                    rows.append((doc, row, pos, h, line_keys(line) if new else []))
                    texts.append(line)
                    held += len(line)
                    if len(rows) >= 20_000 or held > 4_000_000:
                        yield out()
                        rows, texts, held = [], [], 0
        yield out()
        rows, texts, held = [], [], 0


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row, drop): the line numbers, from 0, that repeat an earlier line; row is row_key() of the text.

    Lines of 3 characters or more are one class if at most 2 edits apart, directly or over others; shorter ones if equal. Of
    each class the occurrence with the smallest (doc_id, row, line number) stays, a null doc_id first; the others are listed,
    whether in the same document or in another. Lines without a word and null texts have no part. Repeated rows count as one row.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row", row_key())
    lines = materialize(docs.mapInArrow(_lines, "doc_id long, row long, pos int, id long, mark long, keys array<long>"), "lines")
    spots: list[DataFrame] = []

    def texts(ids: DataFrame) -> DataFrame:
        """Each id's first place, for ids that come again or whose text is asked for; then the texts of the latter."""
        first = lines.groupBy("id").agg(F.min(F.struct("doc_id", "row", "pos")).alias("at"), F.count("*").alias("n"))
        first = first.join(ids.withColumn("asked", F.lit(True)), "id", "left").where("n > 1 or asked")
        spots.append(materialize(first, "spots"))
        places = spots[0].where("asked").groupBy(F.col("at.doc_id").alias("d"), F.col("at.row").alias("r")).agg(F.collect_list(F.struct("id", "at.pos")).alias("held"))
        found = docs.join(places.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")))
        found = found.select(F.split("text", "\n", -1).alias("lines"), F.inline("held"))
        return found.select("id", F.col("lines")[F.col("pos")].alias("payload")).dropDuplicates(["id"])

    members = lines.select(F.explode("keys").alias("key"), "id", "mark")
    labels = materialize(link(members, texts, _fits, Edits), "labels")
    classes = spots[0].join(labels, "id", "left").where("n > 1 or root is not null")
    classes = materialize(classes.select("id", "n", "at", F.coalesce("root", "id").alias("root")), "classes")
    first = materialize(classes.groupBy("root").agg(F.min("at").alias("first")), "first")
    again = materialize(classes.join(first, "root").where("n > 1 or at <> first").select("id", "first"), "again")
    gone = spread_join(lines.select("id", F.struct("doc_id", "row", "pos").alias("at")), again, "id", F.col("at")).where("at <> first")
    return gone.groupBy("at.doc_id", "at.row").agg(F.collect_set("at.pos").alias("drop"))


def drop_duplicate_lines(docs: DataFrame) -> DataFrame:
    """docs with the duplicate lines taken out of text, n_chars (if there) set to the new length, all else unchanged.

    Every row stays; a text of which all lines repeat earlier ones becomes empty, a null text stays null. Any other column may
    have any name.
    """
    gone = materialize(duplicate_lines(docs).select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "drop"), "gone")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), row_key().alias("key"), carried(docs).alias("own"))
    out = rows.join(gone.hint("merge"), F.col("id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("r")), "left")
    split = F.when(F.col("drop").isNotNull(), F.split("own.text", "\n", -1))
    out = out.select("own", "drop", split.alias("lines"))
    keep = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    rest = F.array_join(F.transform(keep, lambda i: F.col("lines")[i]), "\n")
    out = out.select("own", F.when(F.col("drop").isNotNull(), rest).alias("rest"))
    new = F.col("own").withField("text", F.coalesce("rest", "own.text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withField("n_chars", F.coalesce(F.char_length("rest").cast(kind), F.col("own.n_chars")))
    return out.select(new.alias("own")).select("own.*")

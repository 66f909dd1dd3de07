"""SuperMinHash near-duplicate detection over word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, chunks, materialize, row_key, ship, spread_join, text_or_empty
from .linking import Matcher, link

SHINGLE, BANDS, ROWS, PERCENT = 5, 32, 5, 75
#: Sets whose band keys a task remembers having given out already.
GIVEN = 200_000
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word -> 64-bit hash, computed at the first look-up."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: An odd factor for each place in a shingle, without sums that cancel.
_MULT = _mix(np.arange(1, SHINGLE + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's 5-word shingles; one of the whole sequence if it has fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    k = min(SHINGLE, len(w))
    total = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        total += _mix(w[i : len(w) - k + 1 + i]) * _MULT[i]
    return np.unique(_mix(total))


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures (Ertl 2017) of non-empty sets, all in step, as fixed-point numbers j + r.

    Each element draws a random permutation by Fisher-Yates steps and offers r + j to register p[j] at step j. Values of
    step j + 1 can't lower a register below j + 1, so a document stops once all of its registers lie under that.
    """
    sizes = np.array([len(s) for s in sets])
    h, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    out = np.full((len(sets), m), _NONE)
    flat, perm = out.reshape(-1), None
    for j in range(m):
        x = _mix(h + np.uint64(int(_STEP) * (j + 1) & 0xFFFFFFFFFFFFFFFF))
        k = (j + (x & np.uint64(0xFFFFFFFF)) % np.uint64(m - j)).astype(np.int64)
        if perm is None:
            at = k
        else:
            row = np.arange(len(h))
            at = perm[row, k].astype(np.int64)
            perm[row, k] = perm[:, j]
        np.minimum.at(flat, doc * m + at, (np.uint64(j) << np.uint64(32)) | (x >> np.uint64(32)))
        if j == m - 1:
            break
        on = (out.max(axis=1) >= (np.uint64(j + 1) << np.uint64(32)))[doc]
        if not on.any():
            break
        h, doc = h[on], doc[on]
        if perm is None:  # the first step as a swap of the identity
            perm = np.tile(np.arange(m, dtype=np.uint16), (len(h), 1))
            perm[np.arange(len(h)), k[on]] = 0
        else:
            perm = perm[on]
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key per signature and band."""
    parts = signatures.reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        key = _mix(key * _STEP + parts[:, :, i])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, id and band keys of each text's set; no keys where this task gave them for an equal set lately."""
    given: set[int] = set()
    for batch in batches:
        texts = batch.column("text")
        lengths = pc.binary_length(texts).to_pylist()
        for lo, hi in chunks(lengths, 1_000_000):
            sets = [shingle_set(t) for t in texts.slice(lo, hi - lo).to_pylist()]
            ids = [xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63 if len(s) else None for s in sets]
            new = []
            for k, i in enumerate(ids):
                if i is not None and i not in given:
                    if len(given) >= GIVEN:
                        given.clear()
                    given.add(i)
                    new.append(k)
            keys: list = [None] * len(sets)
            if new:
                for k, bands in zip(new, band_keys(super_minhash([sets[k] for k in new], BANDS * ROWS), BANDS, ROWS), strict=True):
                    keys[k] = bands
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    batch.column("row").slice(lo, hi - lo),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "row", "n_shingles", "set_id", "bands"],
            )


class Jaccard(Matcher):
    """100 * intersection >= 75 * union of full shingle sets."""

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)

    def prepare(self, payload: str) -> np.ndarray:
        return shingle_set(payload)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= PERCENT * (len(a) + len(b) - both)

    def all(self, left: list[str], right: list[str], mask: np.ndarray) -> np.ndarray:
        """Intersection sizes of many pairs at once, as a product of 0/1 matrices over the left sets' shingles."""
        if mask.sum() < 500:
            return super().all(left, right, mask)
        out, two = np.zeros(mask.shape, bool), [shingle_set(t) for t in right]
        n2, flat = np.array([len(s) for s in two]), np.concatenate(two)
        owner = np.repeat(np.arange(len(two)), n2)
        one = [shingle_set(t) for t in left]
        for lo, hi in chunks([len(s) for s in one], 20_000):
            n1, mine = np.array([len(s) for s in one[lo:hi]]), np.concatenate(one[lo:hi])
            words = np.unique(mine)
            a = np.zeros((hi - lo, len(words)), np.float32)
            a[np.repeat(np.arange(hi - lo), n1), np.searchsorted(words, mine)] = 1
            at = np.minimum(np.searchsorted(words, flat), len(words) - 1)
            hit = words[at] == flat
            b = np.zeros((len(two), len(words)), np.float32)
            b[owner[hit], at[hit]] = 1
            both = np.rint(a @ b.T).astype(np.int64)
            out[lo:hi] = 100 * both >= PERCENT * (n1[:, None] + n2[None, :] - both)
        return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept, and row (row_key() of the text).

    Documents with Jaccard >= 0.75 of their sets of 5-word shingles (words split at ASCII white space, A-Z lower-cased)
    are linked; component_id is the smallest doc_id reachable. Documents with equal sets are one node from the start.
    Signatures of 160 registers in 32 bands of 5 find a pair at 0.75 with probability 0.9998 and more above; every
    candidate is confirmed on its full sets. Null and empty texts have no shingles and link with nothing. A repeated row
    gets the same answer as its twin; a null doc_id takes part, never names a component, and is kept only where its
    component has no other id. Extra columns are not read.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    docs = docs.withColumn("row", row_key())
    signed = materialize(docs.mapInArrow(_sign, "doc_id long, row long, n_shingles long, set_id long, bands array<long>"), "signed")
    some = signed.where("set_id is not null")
    members = some.select(F.explode("bands").alias("key"), F.col("set_id").alias("id"), F.col("n_shingles").alias("mark"))
    sets: list[DataFrame] = []

    def texts(ids: DataFrame) -> DataFrame:
        """Sets that come again or whose text is asked for, with the row that stands for each; then the texts of the latter."""
        all_ = some.groupBy(F.col("set_id").alias("id")).agg(F.min("doc_id").alias("low"), F.count("*").alias("n"), F.min(F.struct("doc_id", "row")).alias("r"))
        sets.append(materialize(all_.join(ids.withColumn("asked", F.lit(True)), "id", "left").where("n > 1 or asked"), "sets"))
        reps = sets[0].where("asked").select("id", F.col("r.doc_id").alias("rep"), F.col("r.row").alias("rep_row"))
        same = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("row") == F.col("rep_row"))
        return docs.join(reps.hint("merge"), same).select("id", F.col("text").alias("payload")).dropDuplicates(["id"])

    labels = link(members, texts, lambda x, y: F.expr(f"100 * least({x}, {y}) >= {PERCENT} * greatest({x}, {y})"), Jaccard)
    labels = materialize(labels, "labels")
    # Only sets that another document shares or that link with another can have a component beyond the row itself.
    groups = sets[0].join(labels, "id", "left").where("n > 1 or root is not null")
    groups = materialize(groups.select("id", "low", F.coalesce("root", "id").alias("root")), "groups")
    lowest = groups.groupBy("root").agg(F.min("low").alias("component_id"))
    named = materialize(groups.join(lowest, "root").select(F.col("id").alias("set_id"), "component_id"), "named")
    out = spread_join(signed.select("doc_id", "n_shingles", "set_id", "row"), named, "set_id", F.struct("doc_id", "row"), "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "row")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "row")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """docs without the rows that near_duplicates does not keep, all columns unchanged; other columns may have any name."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("d"), F.col("row").alias("r")).distinct()
    gone = materialize(gone, "gone")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), row_key().alias("key"), carried(docs).alias("own"))
    same = F.col("id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("r"))
    return rows.join(gone, same, "left_anti").select("own.*")

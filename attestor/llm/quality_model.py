"""Quality classifier: a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship, text_or_empty
from .quality_rules import STOP_WORDS

FEATURES = (
    "log_chars", "log_words", "word_length", "symbols", "exclamations", "bars", "digits", "capitals", "stops", "stops_own",
    "distinct_words", "top_word", "repeated_pairs", "line_length", "dup_lines", "stops_per_line", "commas",
)
#: Labelled rows that the model is fitted on at most, drawn by a hash of doc_id.
SAMPLE = 20_000
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, LEAVES, RATE, RIDGE = 32, 120, 60, 6, 4, 0.1, 5.0
_STOPS = [(w, w.capitalize()) for w in dict.fromkeys(STOP_WORDS)]


def features(text: str) -> tuple[float, ...]:
    """Figures of one whole text; all 0 for one without words."""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    count = Counter(words)
    stops = [count[w] + count[c] for w, c in _STOPS]
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = sum(map(text.count, "#*$%&<>"))
    pairs = len(set(zip(words, words[1:], strict=False)))
    return (
        float(np.log1p(len(text))),
        float(np.log1p(n)),
        (len(text) - n) / n,
        symbols / n,
        text.count("!") / n,
        text.count("|") / n,
        int(((raw >= 48) & (raw <= 57)).sum()) / len(raw),
        int(((raw >= 65) & (raw <= 90)).sum()) / len(raw),
        sum(stops) / n,
        sum(s > 0 for s in stops) / len(stops),
        len(count) / n,
        max(count.values()) / n,
        1 - pairs / max(1, n - 1),
        float(np.log1p(len(text) / max(1, len(lines)))),
        1 - len(set(lines)) / max(1, len(lines)),
        text.count(".") / n,
        text.count(",") / n,
    )


def _compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [features(t) for t in batch.column("text").to_pylist()]
        cols = zip(*made, strict=True) if made else [()] * len(FEATURES)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.float64()) for c in cols)], ["doc_id", *FEATURES])


@dataclass
class Gam:
    """Intercept, one table a feature, one table a pair of features; a score is a sum of looked-up values."""

    edges: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)], axis=1) if self.edges else np.zeros((len(x), 0), int)

    def probability(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for i, t in enumerate(self.tables):
            z += t[b[:, i]]
        for i, j, t in self.pairs:
            z += t[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree of up to LEAVES leaves over ordered bins, from their sums of gradients and hessians."""
    parts = [(0, len(g))]
    while len(parts) < LEAVES:
        best = (1e-6, None)
        for lo, hi in parts:
            gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            if len(gl):
                gs, hs = g[lo:hi].sum(), h[lo:hi].sum()
                win = _gain(gl, hl) + _gain(gs - gl, hs - hl) - _gain(gs, hs)
                k = int(win.argmax())
                if win[k] > best[0]:
                    best = (win[k], (lo, lo + k + 1, hi))
        if best[1] is None:
            break
        lo, k, hi = best[1]
        parts.remove((lo, hi))
        parts += [(lo, k), (k, hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = RATE * g[lo:hi].sum() / (h[lo:hi].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The four-leaf tree over a grid that splits one axis, then the other on either side; its gain and values."""
    best, out = -1.0, np.zeros(g.shape)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for k in range(1, a.shape[0], max(1, a.shape[0] // 8)):
            value, gain = np.zeros(a.shape), 0.0
            for part in (slice(0, k), slice(k, None)):
                pg, ph = a[part].sum(axis=0), b[part].sum(axis=0)
                gl, hl = np.cumsum(pg)[:-1], np.cumsum(ph)[:-1]
                win = _gain(gl, hl) + _gain(pg.sum() - gl, ph.sum() - hl)
                m = int(win.argmax())
                gain += win[m]
                value[part, : m + 1] = RATE * gl[m] / (hl[m] + RIDGE)
                value[part, m + 1 :] = RATE * (pg.sum() - gl[m]) / (ph.sum() - hl[m] + RIDGE)
            if gain > best:
                best, out = gain, value.T if flip else value
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Cyclic boosting: shallow trees feature by feature, then over the pairs that the rest of the error prefers."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    model = Gam(intercept=float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return model
    model.edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(x.shape[1])]
    b = model.bins(x)
    size = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(n) for n in size]
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, n in enumerate(size):
            g, h = slopes()
            step = _tree(np.bincount(b[:, i], g, n), np.bincount(b[:, i], h, n))
            model.tables[i] += step
            z += step[b[:, i]]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        at = b[:, i] * size[j] + b[:, j]
        return tuple(np.bincount(at, s, size[i] * size[j]).reshape(size[i], size[j]) for s in slopes())

    able = [(i, j) for i, j in combinations(range(len(size)), 2) if size[i] > 1 and size[j] > 1]
    chosen = sorted(able, key=lambda p: -_pair_tree(*grid(*p))[0])[:PAIRS]
    model.pairs = [(i, j, np.zeros((size[i], size[j]))) for i, j in chosen]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            step = _pair_tree(*grid(i, j))[1]
            table += step
            z += step[b[:, i], b[:, j]]
    return model


def _score(batches: Iterator[pa.RecordBatch], model: Gam) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES], axis=1)
        p = model.probability(x)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])


def held_out(doc_id: str = "doc_id"):
    """Rows never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted; higher scores are likelier of quality 1.

    Only figures of the whole text are inputs. The model is fitted on at most `sample` labelled documents that are not held
    out, those of the smallest hashes of doc_id; without both labels among them every score is the share of label 1 (0.5
    without labels). Null texts count as empty and get a score; null ids are not held out and have no label. A repeated label
    row counts once, of several labels of one id the largest. Of different texts of one id the one of the smallest figures is
    learned from; each gets its own score.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    made = materialize(docs.mapInArrow(_compute, "doc_id long, " + ", ".join(f"{c} double" for c in FEATURES)), "features")
    model = fit(*learned(made, labels, sample))
    out = made.mapInArrow(partial(_score, model=model), "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def learned(made: DataFrame, labels: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the bounded sample, in order of doc_id; the same rows whatever the partitions are.

    The hashes that can be among the smallest are known from the number of rows, so about `sample` rows come to the driver in
    all, not from each partition.
    """
    known = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("double").alias("_quality"))
    rows = made.join(known.where(~held_out()), "doc_id").groupBy("doc_id").agg(F.min(F.struct(*FEATURES)).alias("x"), F.first("_quality").alias("y"))
    rows = materialize(rows.withColumn("hash", F.xxhash64("doc_id")), "learned")
    share = (sample + 8 * sample**0.5 + 8) / max(1, rows.count())
    near = rows.where(F.col("hash").cast("double") / 2.0**64 + 0.5 <= share)
    drawn = near.orderBy("hash", "doc_id").limit(sample).select("doc_id", "x.*", "y").toPandas().sort_values("doc_id")
    return drawn[list(FEATURES)].to_numpy(), drawn["y"].to_numpy()

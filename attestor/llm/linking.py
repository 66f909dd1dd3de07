"""Candidate buckets, verified links and components, without all pairs of a group and without a driver-side graph.

`link` is shared by line and document deduplication. The members of a bucket are first compared with up to four leaders
only; members that the links found so far leave outside its largest component are then compared with all others, in blocks
of a bounded size, so no candidate pair is lost, while a group of copies costs a few comparisons a member.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _settled(edges: DataFrame) -> bool:
    """Whether edges(a, b) hang every a below one b that itself hangs below none."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("low")), F.struct(F.col("b").alias("id"), F.lit(0).alias("low")))).alias("e"))
    ends = ends.groupBy("e.id").agg(F.sum("e.low").alias("lows"), F.min("e.low").alias("least"))
    return ends.where("lows > 1 or (lows = 1 and least = 0)").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """Union-find over edges(a, b) as alternating large-star and small-star steps; returns (id, root), root included.

    Each step hangs every node below the smallest neighbour it sees, so chains shorten exponentially. Every minimum is a
    partial aggregate and is written before it is joined, so a hub with many neighbours is split by the join.
    Self-loops and repeated edges are ignored; no edges give no rows.
    """
    now = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while not _settled(now):
        both = now.union(now.select("b", "a"))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "large")
        large = materialize(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "star")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "small")
        low = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(low.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
    ids = now.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return ids.union(now.select("b", "b").distinct())


def _pairs(df: DataFrame, fits: Callable[[str, str], Column]) -> DataFrame:
    """Distinct (a, b), a < b, of rows (x, xm, y, ym) whose marks fit."""
    df = df.where("x <> y").where(fits("xm", "ym"))
    return df.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _star(batches: Iterator[pa.RecordBatch], matcher: type[Matcher]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) with both payloads -> those that link."""
    match = matcher()
    kept: OrderedDict[int, object] = OrderedDict()

    def of(key: int, payload: str) -> object:
        if key not in kept:
            kept[key] = match.prepare(payload)
            if len(kept) > 64:
                kept.popitem(last=False)
        kept.move_to_end(key)
        return kept[key]

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("a", "b", "pa", "pb")), strict=True)
        yield _edges([(a, b) for a, b, x, y in rows if match.linked(of(a, x), of(b, y))])


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _earlier(left: list[dict], right: list[dict], key: int) -> np.ndarray:
    """Which pairs also meet under a smaller key, where they are compared instead."""
    at: dict[int, int] = {}
    for r in left:
        for k in r["keys"]:
            if k < key:
                at.setdefault(k, len(at))
    one, two = (np.zeros((len(rows), max(1, len(at))), np.float32) for rows in (left, right))
    for rows, m in ((left, one), (right, two)):
        for i, r in enumerate(rows):
            for k in r["keys"]:
                if k in at:
                    m[i, at[k]] = 1
    return (one @ two.T) > 0


def _block(rows: list[dict], matcher: Matcher) -> pa.RecordBatch:
    """Two parts of one bucket: the pairs across components that fit, confirmed."""
    left, right = ([r for r in rows if r["side"] == s] for s in (0, 1))
    if not left or not right:
        return _edges([])
    ids, roots, marks = (([np.array([r[c] for r in x]) for x in (left, right)]) for c in ("id", "root", "mark"))
    mask = (roots[0][:, None] != roots[1][None, :]) & matcher.fit(marks[0][:, None], marks[1][None, :])
    mask &= ~_earlier(left, right, rows[0]["key"])
    found = np.argwhere(mask & matcher.all([r["payload"] for r in left], [r["payload"] for r in right], mask)) if mask.any() else ()
    return _edges([(int(ids[0][i]), int(ids[1][j])) for i, j in found])


def _blocks(batches: Iterator[pa.RecordBatch], matcher: type[Matcher]) -> Iterator[pa.RecordBatch]:
    match, rows, at = matcher(), [], None
    for batch in batches:
        for r in batch.to_pylist():
            if (now := (r["key"], r["l"], r["m"])) != at and rows:
                yield _block(rows, match)
                rows = []
            at = now
            rows.append(r)
    if rows:
        yield _block(rows, match)


class Matcher:
    """How two payloads are compared; made once a task."""

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which marks, as 64-bit numbers, can belong to payloads that link."""
        raise NotImplementedError

    def prepare(self, payload: str) -> object:
        return payload

    def linked(self, a: object, b: object) -> bool:
        raise NotImplementedError

    def all(self, left: list[str], right: list[str], mask: np.ndarray) -> np.ndarray:
        """linked() for the pairs of mask."""
        out, one, two = np.zeros(mask.shape, bool), [*map(self.prepare, left)], [*map(self.prepare, right)]
        for i, j in np.argwhere(mask):
            out[i, j] = self.linked(one[i], two[j])
        return out


#: Members of a bucket that meet in one task at most, about.
LEFT, RIGHT = 128, 256


def link(members: DataFrame, payloads: Callable[[DataFrame], DataFrame], fits: Callable[[str, str], Column], matcher: type[Matcher]) -> DataFrame:
    """members(key, id, mark), read twice, so written by the caller -> (id, root) of the verified links.

    Members of one key are candidates if their marks fit. `fits` is matcher.fit as SQL; payloads(ids) gives (id, payload)
    of the ids. An id may come many times in a key, and any number of ids may share one.
    """
    # A key with two ids or more. Both sides of the join are in proportion to the corpus, so it is always a merge; AQE splits a
    # key that fills a partition, as nothing but the writing follows.
    shared = materialize(members.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key"), "shared")
    crowd = materialize(members.join(shared.hint("merge"), "key"), "crowd")
    crowd = materialize(crowd.distinct(), "crowd")
    # Leaders by the same few orders in all keys, so that keys with the same members choose the same ones.
    mixed = F.xxhash64("id", F.pmod("key", F.lit(4)))
    ends = {"0": (F.min_by, F.col("id")), "1": (F.max_by, F.col("id")), "2": (F.min_by, mixed), "3": (F.max_by, mixed)}
    lead = crowd.groupBy("key").agg(F.count("*").alias("n"), *(pick(c, order).alias(c + k) for k, (pick, order) in ends.items() for c in ("id", "mark")))
    leaders = F.array_distinct(F.array(*(F.struct(F.col("id" + k).alias("y"), F.col("mark" + k).alias("ym")) for k in ends)))
    lead = materialize(lead.select("key", "n", leaders.alias("leaders")), "leaders")
    met = crowd.select("key", F.col("id").alias("x"), F.col("mark").alias("xm")).join(lead.select("key", F.inline("leaders")), "key")
    first = materialize(_pairs(met, fits), "pairs")
    # Keys with two members or more besides the leaders: these may have to meet each other.
    wide = crowd.join(lead.where("n > size(leaders) + 1").select("key"), "key", "left_semi")
    ids = first.select(F.explode(F.array("a", "b")).alias("id")).union(wide.select("id")).distinct()
    texts = materialize(payloads(ids), "payloads")
    both = first
    for c in ("a", "b"):
        both = both.join(texts.select(F.col("id").alias(c), F.col("payload").alias("p" + c)), c)
    both = both.select("a", "b", "pa", "pb")
    links = materialize(both.mapInArrow(partial(_star, matcher=matcher), "a long, b long"), "links")
    label = materialize(connected(links), "labels")
    # Members of such a key that are still apart: those outside its largest component meet all of the others.
    apart = wide.join(label, "id", "left").select("key", "id", "mark", F.coalesce("root", "id").alias("root"))
    parts = apart.groupBy("key", "root").count().groupBy("key").agg(F.sum("count").alias("n"), F.max("count").alias("most"), F.max_by("root", "count").alias("big"), F.count("*").alias("roots"))
    parts = parts.where("roots > 1").select("key", "big", F.expr(f"ceil((n - most) / {LEFT})").alias("nl"), F.expr(f"ceil(n / {RIGHT})").alias("nm"))
    parts = materialize(parts, "mixed")
    if parts.isEmpty():
        return label
    apart = materialize(apart.join(parts, "key"), "apart")
    keys = materialize(apart.groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("keys")), "keys")
    part = lambda n, salt: F.expr(f"pmod(xxhash64(id, '{salt}'), {n})")
    left = apart.where("root <> big").select("*", F.lit(0).alias("side"), part("nl", "l").alias("l"), F.explode(F.expr("sequence(0, nm - 1)")).alias("m"))
    right = apart.select("*", F.lit(1).alias("side"), F.explode(F.expr("sequence(0, nl - 1)")).alias("l"), part("nm", "m").alias("m"))
    rows = left.select("key", "l", "m", "side", "id", "root", "mark").union(right.select("key", "l", "m", "side", "id", "root", "mark"))
    rows = rows.join(keys, "id").join(texts, "id")
    rows = rows.repartition("key", "l", "m").sortWithinPartitions("key", "l", "m")
    again = materialize(rows.mapInArrow(partial(_blocks, matcher=matcher), "a long, b long"), "links")
    if again.isEmpty():
        return label
    return connected(links.union(again))

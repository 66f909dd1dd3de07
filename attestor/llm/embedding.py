"""Embedding near-dedup by collision-counting projections."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import ceil, comb, erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, ship
from .linking import connected

COSINE = 0.98
#: Cell width of the projections that deal vectors to blocks; half-width of the query-centred windows and number of the
#: projections that are sorted and counted. Gaussian directions, unit vectors.
CELL, WINDOW, COUNTED = 2.0, 0.4, 16
#: Chance that a pair at the threshold is never met in a block, and that it then falls short of the collision count.
MISS = 1e-3
#: Vectors of one cell sorted together in one task at most, about.
BLOCK = 1024


def same_cell(distance: float) -> float:
    """Chance that two unit vectors so far apart share a cell of one randomly shifted projection."""
    r = CELL / distance
    return erf(r / sqrt(2)) - sqrt(2 / np.pi) / r * (1 - np.exp(-r * r / 2))


def plan(n: int, threshold: float = COSINE) -> tuple[int, int, int]:
    """Projections a cell, groups of cells, and collisions that a candidate needs, for n vectors of the largest label.

    More projections a cell hold the strangers in it to about BLOCK whatever n is; more groups then keep the recall. The
    count is the largest that a pair at the threshold reaches in all but MISS of cases.
    """
    near, far = same_cell(sqrt(2 - 2 * threshold)), same_cell(sqrt(2))
    width = max(0, ceil(log(max(1, n) / BLOCK) / -log(far)))
    groups = ceil(log(MISS) / log(1 - near**width)) if width else 1
    hit = erf(WINDOW / sqrt(2 - 2 * threshold) / sqrt(2))
    need, tail = 0, 0.0
    while (tail := tail + comb(COUNTED, need) * hit**need * (1 - hit) ** (COUNTED - need)) < MISS:
        need += 1
    return width, groups, need


def _directions(dim: int, width: int, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions of the cells, their shifts, and the directions that are sorted."""
    rng = np.random.default_rng(20_240_601)
    counted = rng.standard_normal((dim, COUNTED))
    return rng.standard_normal((dim, width * groups)), rng.uniform(0, CELL, width * groups), counted


def window_pairs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both ends of every collision in one sorted projection: each value's window meets the ones above it, up to WINDOW away."""
    order = np.argsort(values, kind="stable")
    line = values[order]
    after = np.arange(1, len(line) + 1)
    held = np.searchsorted(line, line + WINDOW, "right") - after
    skipped = np.repeat(after - (np.cumsum(held) - held), held)
    return np.repeat(order, held), order[skipped + np.arange(len(skipped))]


def collided(p: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of rows of p that collide in at least `need` of its columns, each column sorted by itself."""
    n = len(p)
    count = np.zeros(n * n, np.uint8)
    for column in p.T:
        a, b = window_pairs(column)
        count[np.minimum(a, b) * n + np.maximum(a, b)] += 1  # a pair comes once a column
    found = np.flatnonzero(count >= need)
    return found // n, found % n


def _scaled(cells: list[bytes], single: bool) -> np.ndarray:
    """Vectors with a largest component of 1, so that squares neither overflow nor vanish."""
    raw = np.stack([np.frombuffer(c, np.float32 if single else np.float64) for c in cells]).astype(np.float64)
    return raw / np.abs(raw).max(axis=1, keepdims=True)


def _project(x: np.ndarray, width: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The projections to be sorted, and the key of each vector's cell in each group."""
    cells, shift, counted = _directions(x.shape[1], width, groups)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cell = np.floor((unit @ cells + shift) / CELL).astype(np.int64).reshape(len(x), groups, width)
    key = np.broadcast_to(np.arange(groups, dtype=np.uint64), (len(x), groups)).copy()
    for i in range(width):
        key = (key ^ cell[:, :, i].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return unit @ counted, key.view(np.int64)


def _cells(batches: Iterator[pa.RecordBatch], width: int, groups: int, single: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column("vec").to_pylist()
        keys: list = [None] * len(raw)
        for size in {len(v) for v in raw}:
            rows = [i for i, v in enumerate(raw) if len(v) == size]
            found = _project(_scaled([raw[i] for i in rows], single), width, groups)[1]
            for i, k in zip(rows, found, strict=True):
                keys[i] = k
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.list_(pa.int64()))], ["id", "cells"])


def _pack(batches: Iterator[pa.RecordBatch], single: bool) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of the floats or doubles that they came in."""
    for batch in batches:
        vec = [np.asarray(v, np.float32 if single else np.float64).tobytes() for v in batch.column("vec").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "space", "copies")), pa.array(vec, pa.binary())], ["id", "space", "copies", "vec"])


def _compare(batches: Iterator[pa.RecordBatch], width: int, groups: int, need: int, single: bool) -> Iterator[pa.RecordBatch]:
    """Blocks of one cell: (a, b, n): n copies that b links to a in this block; where n is 0, an edge of the spanning forest."""

    def run(rows: list[dict]) -> pa.RecordBatch:
        t = rows[0]["t"]
        x = _scaled([r["vec"] for r in rows], single)
        p, keys = _project(x, width, groups)
        side = np.array([r["side"] for r in rows])
        i, j = collided(p, need)
        if side.any():  # two different parts of a large cell
            i, j = (e[side[i] != side[j]] for e in (i, j))
        out: list[tuple[int, int, int]] = []
        links: dict[int, int] = {}
        root = list(range(len(rows)))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for lo in range(0, len(i), 65_536):
            a, b = i[lo : lo + 65_536], j[lo : lo + 65_536]
            first = ~(keys[a, :t] == keys[b, :t]).any(axis=1)  # else an earlier group has compared them
            a, b = a[first], b[first]
            cos = np.einsum("ij,ij->i", x[a], x[b]) / np.sqrt(np.einsum("ij,ij->i", x[a], x[a]) * np.einsum("ij,ij->i", x[b], x[b]))
            for k, m in zip(a[cos >= COSINE].tolist(), b[cos >= COSINE].tolist(), strict=True):
                links[k] = links.get(k, 0) + rows[m]["copies"]
                links[m] = links.get(m, 0) + rows[k]["copies"]
                if (r := find(k)) != (s := find(m)):
                    root[s] = r
                    out.append((rows[k]["id"], rows[m]["id"], 0))
        out += [(rows[k]["id"], rows[k]["id"], n) for k, n in links.items()]
        cols = zip(*out, strict=True) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "n"])

    rows, at = [], None
    for batch in batches:
        for r in batch.to_pylist():
            if (now := (r["key"], r["l"], r["m"])) != at and rows:
                yield run(rows)
                rows = []
            at = now
            rows.append(r)
    if rows:
        yield run(rows)


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row per row of vectors(vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows of one label (not null) and one dimension with cosine >= 0.98, in double precision, are linked; pairs below it
    never are. Equal vectors of a label are collapsed first and counted again afterwards. Vectors are dealt to blocks by the cells
    of a few projections, in several groups of blocks; within a block each of 16 further projections is sorted, every
    vector's window of a fixed half-width is read off the order, the collisions are counted per pair, and pairs with
    enough of them are verified. Cells, groups and count are set by `plan` for a recall over 0.99 at the threshold. (Windows
    of one projection hold a fixed share of all strangers however many there are, so they are opened inside blocks.)
    A cell of many vectors is compared in parts. Null and zero vectors and those with null or non-finite components link with nothing: n_links 0, their
    own component. A repeated vec_id counts as another vector; a null vec_id takes part but names no component.
    """
    ship(vectors.sparkSession)
    good = "embedding is not null and size(embedding) > 0 and label is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    rows = rows.withColumn("embedding", F.when(F.coalesce(F.expr(good), F.lit(False)), F.expr("transform(embedding, x -> x + 0.0D)")))
    rows = rows.withColumn("id", F.when(F.col("embedding").isNotNull(), F.xxhash64("label", "embedding")))
    alone = materialize(
        rows.where("id is not null").groupBy("id").agg(F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("vec"), F.min("vec_id").alias("low")), "vectors"
    )
    packed = alone.withColumn("space", F.xxhash64("label", F.size("vec"))).select("id", "space", "copies", "vec")
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType(), vectors.schema["embedding"].dataType.containsNull)
    packed = materialize(packed.mapInArrow(partial(_pack, single=single), "id long, space long, copies long, vec binary"), "packed")
    most = packed.groupBy("space").count().agg(F.max("count")).first()[0] or 1
    width, groups, need = plan(most)
    cells = packed.select("id", "vec").mapInArrow(partial(_cells, width=width, groups=groups, single=single), "id long, cells array<long>")
    cells = packed.select("id", "space").join(materialize(cells, "cells"), "id").select("id", "space", F.posexplode("cells").alias("t", "cell"))
    cells = materialize(cells.select(F.xxhash64("space", "t", "cell").alias("key"), "t", "id"), "cells")
    full = materialize(cells.groupBy("key").count().where("count > 1").select("key", F.expr(f"ceil(count / {BLOCK})").alias("nb")), "full")
    rows_in = cells.join(full, "key").withColumn("mine", F.expr("pmod(xxhash64(id), nb)"))
    # block (l, m) with l <= m compares part l with part m; a part is on side 0 as l and on side 1 as m
    rows_in = rows_in.withColumn("other", F.explode(F.expr("sequence(0, nb - 1)")))
    rows_in = rows_in.select("key", "t", "id", F.least("mine", "other").alias("l"), F.greatest("mine", "other").alias("m"), F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"))
    rows_in = rows_in.join(packed.select("id", "copies", "vec"), "id").repartition("key", "l", "m").sortWithinPartitions("key", "l", "m")
    found = materialize(rows_in.mapInArrow(partial(_compare, width=width, groups=groups, need=need, single=single), "a long, b long, n long"), "found")
    counts = found.where("n > 0").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    label = materialize(connected(found.where("n = 0").select("a", "b")), "labels")
    groups_ = alone.select("id", "copies", "low").join(counts, "id", "left").join(label, "id", "left")
    groups_ = materialize(groups_.select("id", F.expr("coalesce(n, 0) + copies - 1").alias("n_links"), "low", F.coalesce("root", "id").alias("root")), "groups")
    lowest = groups_.groupBy("root").agg(F.min("low").alias("component"))
    named = materialize(groups_.join(lowest, "root").select("id", "n_links", "component"), "named")
    out = rows.select("vec_id", "id").join(named, "id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))

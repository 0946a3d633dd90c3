"""Embedding near-dedup with spherical-cap filters from structured random product codes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.writers import materialise
from .cells import Forest, deal, starts_of_groups, whole_groups
from .components import components
from .pieces import list_column


class ProductCode:
    """Filter directions of one dimension.

    In each of ``rounds`` seeded random rotations the coordinates are cut into two blocks. A block's code words are plus and minus its unit vectors; a
    direction is one word of either block together. The inner product with a direction is then a sum of two coordinates, so all
    directions are decoded from one sorted list per block. A vector gets every direction whose cap {x: <x, direction> >= cut} holds it; the cut is
    set so that a random vector gets ``expected`` per rotation. A vector with fewer than ``least`` gets its best ``least``.
    """

    def __init__(self, dim: int, rounds: int = 3, expected: float = 8.0, least: int = 4, seed: int = 20):
        rng = np.random.default_rng([seed, dim])
        self.dim, self.least, self.rounds = dim, least, rounds
        self.rotations = [np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(rounds)]
        self.half = max(1, dim // 2)
        self.words = (2 * self.half, max(1, 2 * (dim - self.half)))
        trial = rng.normal(size=(2000, dim))
        trial /= np.linalg.norm(trial, axis=1, keepdims=True)
        scores = self._scores(trial, 0)
        rank = min(int(expected * len(trial)), scores.size - 1)
        self.cut = np.partition(scores.ravel(), scores.size - 1 - rank)[scores.size - 1 - rank]

    def _scores(self, x: np.ndarray, at: int) -> np.ndarray:
        """Inner products with all directions of a rotation: a row of words of block one times words of block two."""
        y = x @ self.rotations[at]
        a, b = y[:, :self.half], y[:, self.half:]
        both = [np.concatenate([z, -z], axis=1) if z.shape[1] else np.zeros((len(x), 1)) for z in (a, b)]
        return ((both[0][:, :, None] + both[1][:, None, :]) / np.sqrt(2)).reshape(len(x), -1)

    def decode(self, x: np.ndarray, part: int = 256) -> list[np.ndarray]:
        """For each unit vector the ascending numbers of its directions."""
        out = [[] for _ in range(len(x))]
        for begin in range(0, len(x), part):
            for at in range(self.rounds):
                scores = self._scores(x[begin:begin + part], at)
                count = scores.shape[1]
                least = min(self.least, count)
                fair = np.minimum(self.cut, np.partition(scores, count - least, axis=1)[:, count - least])
                rows, found = np.nonzero(scores >= fair[:, None])
                cuts = np.searchsorted(rows, np.arange(len(scores) + 1))
                for i in range(len(scores)):
                    out[begin + i].append(found[cuts[i]:cuts[i + 1]] + at * count)
        return [np.concatenate(x) for x in out]


@lru_cache(maxsize=16)
def product_code(dim: int) -> ProductCode:
    return ProductCode(dim)


def usable(embedding: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


_CELL = ["label", "dim", "filter", "cell_a", "cell_b"]


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(float).reshape(rows, -1)


def _filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        vectors = batch.column("embedding").to_pylist()
        found: list = [None] * batch.num_rows
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            x = np.array([vectors[i] for i in at], float)
            x /= np.abs(x).max(axis=1, keepdims=True)  # very large and very small vectors
            for i, filters in zip(at, product_code(dim).decode(x / np.linalg.norm(x, axis=1, keepdims=True)), strict=True):
                found[i] = filters
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "label", "dim", "copies", "embedding")), list_column(found, pa.int32())],
                                         ["node", "label", "dim", "copies", "embedding", "filters"])


def _found_before(filters: list[np.ndarray], current: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs share a filter before the current one, and so are counted there."""
    earlier = [f[f < current] for f in filters]
    every = np.unique(np.concatenate(earlier))
    if not len(every):
        return np.zeros(len(a), bool)
    has = np.zeros((len(filters), len(every)), np.float32)
    for i, f in enumerate(earlier):
        has[i, np.searchsorted(every, f)] = 1
    return (has @ has.T)[a, b] > 0


def _verified(least: float, block: int = 512):
    """Links inside each cell, in double precision: per vector the copies of linked vectors found here first, and one of its group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in whole_groups(batches, _CELL):
            starts = starts_of_groups(cells, _CELL)
            nodes, roots, counts = [], [], []
            for begin, end in zip(starts, starts[1:], strict=False):
                if end - begin < 2:
                    continue
                cell = cells.slice(begin, end - begin).combine_chunks()
                n = cell.num_rows
                x = _matrix(cell.column("embedding").chunk(0), n)
                scale = np.abs(x).max(axis=1, keepdims=True)
                x = x / scale
                norm = np.linalg.norm(x, axis=1)
                chunk = cell.column("chunk").to_numpy()
                two = cell.column("cell_a")[0].as_py() != cell.column("cell_b")[0].as_py()
                pairs = []
                for at in range(0, n, block):
                    cosine = x[at:at + block] @ x.T / (norm[at:at + block, None] * norm)
                    i, j = np.nonzero(cosine >= least)
                    pairs.append(np.stack([i + at, j])[:, i + at < j])
                a, b = np.concatenate(pairs, axis=1)
                if two:
                    across = chunk[a] != chunk[b]
                    a, b = a[across], b[across]
                if not len(a):
                    continue
                linked = np.unique(np.concatenate([a, b]))
                place = np.searchsorted(linked, np.arange(n))
                filters = [np.asarray(f) for f in cell.column("filters").take(linked).to_pylist()]
                first = ~_found_before(filters, cell.column("filter")[0].as_py(), place[a], place[b])
                copies = cell.column("copies").to_numpy()
                count = np.bincount(a[first], copies[b[first]], n) + np.bincount(b[first], copies[a[first]], n)
                forest = Forest(n)
                forest.link(a, b)
                ids = cell.column("node").to_numpy()
                nodes.append(ids[linked])
                roots.append(ids[forest.root[linked]])
                counts.append(count[linked].astype(np.int64))
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (nodes, roots, counts)], ["a", "b", "n"])
    return run


def near_duplicates(vectors: DataFrame, least: float = 0.93, most: int = 1000, id_col: str = "vec_id", embedding: str = "embedding",
                    label: str = "label") -> DataFrame:
    """Per row of ``vectors``: vec_id, ``n_links`` (other rows linked directly), ``component_id`` (smallest vec_id reachable), ``kept``.

    Rows link where labels are equal and the cosine in double precision is at least ``least``. Equal vectors of a label are one before any pair is looked at,
    with their number. Each distinct vector goes to its filters; vectors that meet in a filter are compared there, and a pair that meets in
    several is counted in the first. A filter gives one row per linked vector and no list of pairs; a filter with over ``most`` rows is split.

    Vectors that are null, zero or of null or non-finite components, and rows without a label, link with nothing; vectors of different
    lengths never link; repeated rows are links of each other; a null id is the smallest only where all are null; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    fine = F.col("label").isNotNull() & usable(F.col("embedding"))
    classes = rows.filter(fine).groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()))
    numbered = classes.select("node", "label", F.size("embedding").alias("dim"), "copies", "embedding")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema) + ", filters array<int>"
    filtered = materialise(numbered.mapInArrow(_filtered, schema))
    met = deal(filtered.withColumn("filter", F.explode("filters")), ["label", "dim", "filter"], F.xxhash64("node"), most)
    met = met.repartition(*_CELL).sortWithinPartitions(*_CELL, "node")
    found = materialise(met.select(*_CELL, "chunk", "node", "copies", "embedding", "filters").mapInArrow(_verified(least), "a long, b long, n long"))
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    labels = components(found.select("a", "b"))
    known = classes.join(counts, "node", "left").join(labels.withColumnRenamed("label", "component"), "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    smallest = known.groupBy("component").agg(F.min("first").alias("component_id"))
    known = materialise(known.join(smallest, "component").select(F.col("label").alias("_label"), F.col("embedding").alias("_embedding"), "component_id",
                                                                 (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    linked = rows.filter(fine).join(known, (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")))
    alone = rows.filter(~F.coalesce(fine, F.lit(False)))
    out = linked.select("vec_id", "n_links", "component_id").union(alone.select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

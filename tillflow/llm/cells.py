"""Helpers of the pair operators: splitting hot buckets, and reading sorted rows group by group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.writers import materialise


def deal(rows: DataFrame, keys: Sequence[str], spread: Column, most: int) -> DataFrame:
    """Rows of one bucket (equal ``keys``) dealt to cells of about ``2 * most`` rows in which any two of the bucket meet.

    A bucket of more than ``most`` rows is cut into chunks by the hash ``spread``, and for every two chunks there is a cell with the rows
    of both. Adds ``cell_a``, ``cell_b`` and ``chunk`` (the row's own): in a cell of two chunks only rows of different chunks are
    a pair to look at, so no pair is looked at twice. The rows are read twice, so they should come from a table.
    """
    big = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    big = materialise(big.select(*keys, F.ceil(F.col("_n") / most).alias("_chunks")))
    chunks = F.coalesce("_chunks", F.lit(1).cast("long"))
    rows = rows.join(big, list(keys), "left").withColumn("chunk", F.pmod(spread, chunks).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), (chunks - 1).cast("int"))))
    rows = rows.withColumn("cell_a", F.least("chunk", "_other")).withColumn("cell_b", F.greatest("chunk", "_other"))
    return rows.drop("_n", "_chunks", "_other")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Sorted rows in tables that never cut a group: the last group of a batch waits for the next batch."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        same = np.ones(table.num_rows, bool)
        for key in keys:
            values = table.column(key).to_numpy()
            same &= values == values[-1]
        start = table.num_rows - int(same[::-1].argmin()) if not same.all() else 0
        if start:
            yield table.slice(0, start).combine_chunks()
        rest = table.slice(start)
    if rest is not None:
        yield rest.combine_chunks()


def starts_of_groups(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """The first row of every group, and the number of rows."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


class Forest:
    """Union-find over the rows of a table; ``root`` is kept flat, so it can be read as an array."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unite the rows of every pair; the smaller row stays the root."""
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                return
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                flat = self.root[self.root]
                if (flat == self.root).all():
                    break
                self.root = flat

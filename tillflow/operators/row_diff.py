"""Differences of two tables down to the row, by checksums first.

Two exports of the same data mostly agree. Order-free checksums by bucket tell where they do not, a second level cuts those buckets, and only rows of
cells that differ are compared with one another.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.writers import materialise
from .joins import null_safe_join


def _hash(cols: Sequence[str], seed: int) -> Column:
    # the hash leaves nulls out, so where they stand is hashed too
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in cols], *[F.col(c).isNull() for c in cols])


# a cell of the second level has about so many rows: a bucket of fewer is compared at once, as checksums of cells would be about as many as its rows
CELL_ROWS = 4096


def cells_of(n_rows: Column, cells: int) -> Column:
    """How many cells a bucket of ``n_rows`` is cut into."""
    return F.greatest(F.lit(1), F.least(F.lit(cells), F.ceil(n_rows / CELL_ROWS))).cast("int")


def _differing(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups in which the two sides have other rows or other numbers of equal rows, by count and two sums of 64 hash bits; ``_rows`` counts both sides."""
    signed = lambda c: F.sum(F.col("_side") * F.col(c).cast("decimal(20,0)"))
    sums = rows.groupBy(*by).agg(F.sum("_side").alias("_n"), signed("_h1").alias("_a"), signed("_h2").alias("_b"), F.count(F.lit(1)).alias("_rows"))
    return sums.filter("_n != 0 or _a != 0 or _b != 0").select(*by, "_rows")


def _within(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    other = groups.select(*[F.col(c).alias(f"_g_{c}") for c in by])
    return rows.join(other, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by]), "left_semi")


def differing_buckets(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """The values of ``by`` under which the two tables differ. What is shuffled is one row per task and bucket."""
    return _differing(_both(left, right), by).drop("_rows")


def _both(left: DataFrame, right: DataFrame) -> DataFrame:
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"the tables have other columns: {sorted(set(left.columns) ^ set(right.columns))}")
    both = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    return both.withColumns({"_h1": _hash(left.columns, 1), "_h2": _hash(left.columns, 2)})


def differing_rows(left: DataFrame, right: DataFrame, by: Sequence[str], key: Sequence[str], cells: int = 256) -> DataFrame:
    """Rows that the tables do not have equally often: their columns, ``n_left``, ``n_right`` and ``kind``.

    ``by`` names the buckets of the first level, such as campaign and day; the second level cuts a differing bucket of many rows into up to ``cells`` by its rows'
    ``key``, and smaller ones are one cell. The kinds: ``left only`` and ``right only`` (the other table has no row of that key in the bucket), ``changed`` (it has one with other values), ``repeated`` (the same
    row another number of times). Nulls are values. Doubles are compared exactly, so round them before where sources round differently. Two
    buckets with other rows look equal with a chance of 2^-128.
    """
    rows = _both(left, right)
    # staged, so that the planner knows its size before the rows are moved to meet it
    buckets = materialise(_differing(rows, by).select(*by, cells_of(F.col("_rows"), cells).alias("_cells")))
    found = null_safe_join(rows, buckets, by, "inner")
    if not buckets.filter("_cells > 1").isEmpty():
        found = found.withColumn("_cell", F.pmod(_hash(key, 3), F.col("_cells")).cast("int"))
        large = found.filter("_cells > 1")
        found = found.filter("_cells = 1").unionByName(_within(large, _differing(large, [*by, "_cell"]), [*by, "_cell"]))
    rows = found
    columns = left.columns
    counted = rows.groupBy(*columns).agg(F.count_if(F.col("_side") == 1).alias("n_left"), F.count_if(F.col("_side") == -1).alias("n_right"))
    unequal = counted.filter("n_left != n_right")
    # which sides know the key at all, from every row of the cells
    whole = list(dict.fromkeys([*by, *key]))
    known = counted.groupBy(*whole).agg((F.sum("n_left") > 0).alias("_in_left"), (F.sum("n_right") > 0).alias("_in_right"))
    known = known.withColumnsRenamed({k: f"_g_{k}" for k in whole})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in whole])
    kind = (F.when((F.col("n_left") > 0) & (F.col("n_right") > 0), "repeated").when(~F.col("_in_right"), "left only")
             .when(~F.col("_in_left"), "right only").otherwise("changed"))
    return unequal.join(known, same).select(*columns, "n_left", "n_right", kind.alias("kind"))

"""Latest or first row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], order_cols: Sequence[str],
                   desc: bool = True, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per key: the highest (or lowest) ``order_cols``, ties settled by ``tie_break``.

    The row_number = 1 filter gives the plan a map-side group limit, so every task sends one row per key to the
    shuffle; a key that holds a third of the table costs its window task only one row per input task.
    """
    direction = (lambda c: F.col(c).desc()) if desc else (lambda c: F.col(c).asc())
    spec = W.partitionBy(*keys).orderBy(*[direction(c) for c in [*order_cols, *tie_break]])
    return df.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")

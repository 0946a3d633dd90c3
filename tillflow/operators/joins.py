"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; the key columns of ``left`` are kept."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def with_group_value(df: DataFrame, keys: Sequence[str], **aggregates) -> DataFrame:
    """Attach a per-group aggregate to every row.

    Does the work of ``agg OVER (PARTITION BY keys)`` without moving a whole group into one task: the aggregate is
    combined map-side, and the join back is broadcast when the group table is small, else a sort-merge join whose
    hot partitions AQE splits.
    """
    groups = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggregates.items()])
    return null_safe_join(df, groups, keys)


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left_anti")

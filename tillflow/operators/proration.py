"""Spreading a pooled cost over rows by their share of a measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import safe_divide
from .joins import with_group_value


def add_share(df: DataFrame, measure: str, partition: Sequence[str], out: str) -> DataFrame:
    """``measure`` divided by its total in the partition; NULL where the total is zero.

    The totals are a map-side combined aggregate joined back, because a partition such as (month, country) can hold
    a large part of the table.
    """
    return (with_group_value(df, partition, _total=F.sum(measure))
            .withColumn(out, safe_divide(F.col(measure), F.col("_total"))).drop("_total"))


def prorate(df: DataFrame, measure: str, pool: str, partition: Sequence[str], out: str,
            null_pool_is_zero: bool = True) -> DataFrame:
    """``out`` = share of ``measure`` in the partition times ``pool`` (a column that repeats per partition)."""
    amount = F.coalesce(F.col(pool), F.lit(0.0)) if null_pool_is_zero else F.col(pool)
    return add_share(df, measure, partition, "_share").withColumn(out, F.col("_share") * amount).drop("_share")

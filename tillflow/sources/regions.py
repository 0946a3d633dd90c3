"""Tables that exist once per region with the same shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def region_union(tables: Mapping[str, DataFrame], columns: Sequence[str] | None = None, tag: str = "region"
                 ) -> DataFrame:
    """Stack the regional tables by column name with a region tag.

    ``columns`` picks a common subset; without it the tables must have the same columns.
    """
    parts = [df.select(F.lit(region).alias(tag), *(columns or df.columns)) for region, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def all_regions(tables: Mapping[str, Mapping[str, DataFrame]], columns: Mapping[str, Sequence[str]] = {}
                ) -> dict[str, DataFrame]:
    """Union many tables at once: ``{table: {region: frame}}`` to ``{table: frame}``."""
    return {name: region_union(parts, columns.get(name)) for name, parts in tables.items()}

"""Merging metrics of several facts on a shared key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def merge_metrics(keys: Sequence[str], facts: Sequence[DataFrame], fill: Mapping[str, object] | object = 0
                  ) -> DataFrame:
    """Every key that any fact knows, with the measures of all facts side by side.

    Facts hold one row per key; their other columns are measures with distinct names. ``fill`` replaces missing
    measures: one value for all, a mapping per measure, or None. One union and one aggregation do the work, so the
    number of shuffles does not grow with the number of facts. NULL key parts are treated as equal.
    """
    measures = {f.name: f.dataType for df in facts for f in df.schema.fields if f.name not in keys}
    padded = [df.select(*keys, *[F.col(m) if m in df.columns else F.lit(None).cast(t).alias(m)
                                 for m, t in measures.items()]) for df in facts]
    merged = reduce(DataFrame.unionByName, padded).groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures])
    fills = fill if isinstance(fill, Mapping) else ({} if fill is None else dict.fromkeys(measures, fill))
    return merged.select(*keys, *[F.coalesce(F.col(m), F.lit(fills[m]).cast(t)).alias(m) if m in fills
                                  else F.col(m) for m, t in measures.items()])


def reconcile(a: DataFrame, b: DataFrame, date_col: str, measure: str, by: Sequence[str] = (),
              suffixes: tuple[str, str] = ("export", "warehouse")) -> DataFrame:
    """Monthly totals of two sources side by side; months are those of ``a``."""
    def monthly(df: DataFrame, name: str) -> DataFrame:
        return (df.filter(F.col(date_col).isNotNull())
                  .groupBy(*by, F.trunc(F.col(date_col), "MM").alias("month"))
                  .agg(F.sum(measure).alias(f"{measure}_{name}")))
    return monthly(a, suffixes[0]).join(monthly(b, suffixes[1]), [*by, "month"], "left")


def annual_totals(monthly: DataFrame, month_col: str, measure: str, by: Sequence[str] = ()) -> DataFrame:
    return (monthly.filter(F.col(month_col).isNotNull())
                   .groupBy(F.year(month_col).alias("year"), *by).agg(F.sum(measure).alias(measure)))


def with_baseline(df: DataFrame, value: str, label: str = "metric_type") -> DataFrame:
    """The metric stacked on its own negative, tagged main and baseline.

    One pass over the input: each row is exploded to its two signed copies.
    """
    copies = F.explode(F.array(F.struct(F.lit("main").alias("t"), F.col(value).alias("v")),
                               F.struct(F.lit("baseline").alias("t"), (-F.col(value)).alias("v"))))
    rest = [c for c in df.columns if c != value]
    return df.select(*rest, copies.alias("_c")).select(F.col("_c.t").alias(label), *rest, F.col("_c.v").alias(value))


def unmapped(df: DataFrame, mapping: DataFrame, keys: Sequence[str], ignore_case: bool = False) -> DataFrame:
    """Distinct key tuples of ``df`` that ``mapping`` lacks."""
    norm = (lambda c: F.lower(c)) if ignore_case else (lambda c: c)
    known = mapping.select(*[norm(F.col(k)).alias(f"_m_{k}") for k in keys]).distinct()
    on = reduce(lambda x, y: x & y, [norm(F.col(k)) == F.col(f"_m_{k}") for k in keys])
    return df.select(*keys).distinct().join(known, on, "left_anti")

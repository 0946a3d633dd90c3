"""Effective-dated reference data: turn change dates into ranges, then look facts up in them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

FAR_FUTURE = "9999-12-31"


def effective_ranges(df: DataFrame, keys: Sequence[str], date_col: str, closed: bool = True,
                     from_col: str = "from_date", to_col: str = "to_date") -> DataFrame:
    """Replace ``date_col`` by ``[from_date, to_date]``.

    ``closed`` ends a range the day before the next change, so ranges never overlap; the touching form ends it on
    the next change. A group is the change list of one key, at most one change per day.
    """
    following = F.lead(date_col).over(W.partitionBy(*keys).orderBy(date_col))
    end = F.date_sub(following, 1) if closed else following
    return (df.withColumn(to_col, F.coalesce(end, F.lit(FAR_FUTURE).cast("date")))
              .withColumnRenamed(date_col, from_col))


def asof_range_join(fact: DataFrame, ranges: DataFrame, on: dict[str, str | Column], fact_date: str | Column,
                    from_col: str = "from_date", to_col: str = "to_date", how: str = "left", by_year: bool = False) -> DataFrame:
    """Look up the range row that covers ``fact_date``.

    ``on`` maps a range column to the fact column (or expression) it must equal. The equal keys make this a hash or
    sort-merge join with the date test as residual, so it never becomes a nested loop. Key and range columns of the
    range side are dropped from the result. Where ``on`` holds constants alone, which are no join key, ``by_year`` adds one: each
    range is entered under every year it touches, years before 1900 and after 2100 as one, and a fact looks into its own.
    """
    marked = ranges.select(*[F.col(c).alias(f"_rg_{c}") if c in (*on, from_col, to_col) else F.col(c)
                             for c in ranges.columns])
    day = F.col(fact_date) if isinstance(fact_date, str) else fact_date
    tests = [(F.col(v) if isinstance(v, str) else v) == F.col(f"_rg_{k}") for k, v in on.items()]
    tests.append(day.cast("date").between(F.col(f"_rg_{from_col}"), F.col(f"_rg_{to_col}")))
    if by_year:
        year = lambda d: F.greatest(F.lit(1900), F.least(F.lit(2100), F.year(d)))
        marked = marked.withColumn("_rg_year", F.explode(F.sequence(year(F.col(f"_rg_{from_col}")), year(F.col(f"_rg_{to_col}")))))
        tests.append(year(day.cast("date")) == F.col("_rg_year"))
    return fact.join(marked, reduce(lambda a, b: a & b, tests), how).drop(
        *[f"_rg_{c}" for c in (*on, from_col, to_col)], "_rg_year")

"""Date helpers; every result is a DATE, no helper reads the clock."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import _col


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "MM")


def next_month_start(c: Column | str) -> Column:
    return F.add_months(month_start(c), 1)


def date_steps(start: Column, end: Column, step: str = "day") -> Column:
    """Array of dates from ``start`` to ``end``; NULL (so ``explode`` yields no row) when start > end."""
    return F.when(start <= end, F.sequence(start, end, F.expr(f"interval 1 {step}")))


def parse_datetime(c: Column | str, fmt: str = "dd-MM-yyyy hh:mma") -> Column:
    """Text such as ``03-11-2024 09:30pm``; unparsable text gives NULL."""
    return F.try_to_timestamp(F.upper(_col(c)), F.lit(fmt))

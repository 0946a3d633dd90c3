"""Levels over time by a sweep line: what starts and ends is counted on its day, and running sums give the level of every day.

The rows are two per interval, however long it is; expanding an interval gives one per day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .joins import null_safe_join
from .ranged import along, in_ranges

# the last day a step that never ends is given
OPEN_END = "9999-12-31"


def signed_events(spans: DataFrame, start: Column, end: Column, dims: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """(dims, day, measures): each measure's change of level on a day. A span counts from ``start`` to ``end``, both included; one that ends before its
    start or lacks a bound counts nowhere. Measures should be integers, as sums of doubles depend on their order."""
    sides = [F.struct(day.alias("day"), *[(m * sign).alias(name) for name, m in measures.items()]) for day, sign in ((start, 1), (F.date_add(end, 1), -1))]
    events = spans.filter(start <= end).select(*dims, F.explode(F.array(*sides)).alias("_e"))
    return events.groupBy(*dims, F.col("_e.day").alias("day")).agg(*[F.sum(F.col("_e")[name]).alias(name) for name in measures])


def levels(changes: Sequence[DataFrame], dims: Sequence[str], measures: Sequence[str], until: str = OPEN_END) -> DataFrame:
    """The step function of summed :func:`signed_events`: (dims, from_day, to_day, measures) for every stretch of days with equal levels.

    Days after the last change of a segment have the level that it leaves, up to ``until``; a stretch in which every measure is 0 is left out.
    """
    merged = None
    for events in changes:
        rows = events.select(*dims, "day", *[F.col(m) if m in events.columns else F.lit(0).cast("long").alias(m) for m in measures])
        merged = rows if merged is None else merged.unionByName(rows)
    merged = merged.groupBy(*dims, "day").agg(*[F.sum(m).alias(m) for m in measures])
    # a day on which equal amounts start and end changes nothing
    merged = merged.filter(F.array_contains(F.array(*[F.coalesce(F.col(m), F.lit(0)) != 0 for m in measures]), True))
    ranged = in_ranges(merged.withColumnsRenamed({m: f"_d_{m}" for m in measures}), dims, ["day"])
    run = along(ranged, dims, ["day"], {m: f"_d_{m}" for m in measures}, following={"_next": "day"})
    last = F.coalesce(F.date_sub("_next", 1), F.lit(until).cast("date"))
    steps = run.select(*dims, F.col("day").alias("from_day"), last.alias("to_day"), *measures)
    return steps.filter(F.array_contains(F.array(*[F.col(m) != 0 for m in measures]), True))


def stretches(spans: DataFrame, keys: Sequence[str], start: Column, end: Column, by: Sequence[str] = (), **aggregates: Column) -> DataFrame:
    """(keys, by, from_day, to_day, aggregates): the spans of a key cut on every day on which one of them starts or has ended, and aggregated by
    stretch and ``by``.

    On the days of a stretch the same spans stand, so an aggregate by stretch is that of each of its days. A key's cuts are one array, at most as long as its
    calendar; days are listed afterwards, with :func:`by_day`. Spans that end before their start or lack a bound count nowhere; null keys are values.
    ``aggregates`` read the columns of the spans.
    """
    given = spans.withColumns({"_a": start, "_b": end}).filter("_a <= _b")
    cuts = given.select(*keys, F.explode(F.array(F.col("_a"), F.date_add("_b", 1))).alias("_cut")).groupBy(*keys).agg(F.sort_array(F.collect_set("_cut")).alias("_cuts"))
    own = F.filter("_cuts", lambda d: (d >= F.col("_a")) & (d <= F.col("_b")))
    # a span's own cuts begin with its first day; each stands until the next one
    pieces = null_safe_join(given, cuts, keys).withColumn("_own", own)
    until = lambda i: F.date_sub(F.coalesce(F.get("_own", i + 1), F.date_add("_b", 1)), 1)
    pieces = pieces.withColumn("_piece", F.explode(F.transform("_own", lambda d, i: F.struct(d.alias("a"), until(i).alias("b")))))
    return pieces.groupBy(*keys, *by, F.col("_piece.a").alias("from_day"), F.col("_piece.b").alias("to_day")).agg(*[c.alias(name) for name, c in aggregates.items()])


def by_day(steps: DataFrame, first, last, out: str = "day") -> DataFrame:
    """One row per day of every stretch, clipped to [first, last]."""
    a, b = F.greatest("from_day", F.lit(first).cast("date")), F.least("to_day", F.lit(last).cast("date"))
    return steps.filter(a <= b).withColumn(out, F.explode(F.sequence(a, b))).drop("from_day", "to_day")


def at_month_starts(steps: DataFrame, first, last, out: str = "month") -> DataFrame:
    """The levels on the first days of months in [first, last]."""
    a, b = F.greatest("from_day", F.lit(first).cast("date")), F.least("to_day", F.lit(last).cast("date"))
    on_or_after = F.when(a == F.trunc(a, "MM"), a).otherwise(F.add_months(F.trunc(a, "MM"), 1))
    rows = steps.filter(on_or_after <= b)
    return rows.withColumn(out, F.explode(F.sequence(on_or_after, b, F.expr("interval 1 month")))).drop("from_day", "to_day")

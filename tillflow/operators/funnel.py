"""Funnels of any number of steps with a time limit between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.writers import Stages, materialise, materialise_buckets
from .ranged import RANGE, in_ranges, last_before


def funnel(events: DataFrame, user: str, time: str, kind: str, steps: Sequence[str], within: Column) -> DataFrame:
    """(user, reached, time_1 .. time_n): for each user of the first step when each step was first reached, and how many were.

    An event reaches step k if the user reached step k - 1 strictly before it and not longer ago than the interval ``within``; any event of the first
    kind reaches step 1. The latest time of the step before decides, so every chain of events counts, not only that of first events. ``steps``
    are distinct kinds; other kinds, and events without a time, are left out. A null user is a user.

    The events are sorted into ranges once. For each further step the last time of the step before is carried along the ranges, so a user with a third of
    the events is worked on by many tasks.
    """
    if len(set(steps)) != len(steps) or not steps:
        raise ValueError(f"steps must be distinct: {list(steps)}")
    number = F.array_position(F.lit(list(steps)), F.col("_kind")).cast("int")
    rows = events.select(F.col(user).alias("_user"), F.col(time).alias("_time"), F.col(kind).alias("_kind"))
    rows = rows.filter(F.col("_kind").isin(*steps) & F.col("_time").isNotNull()).withColumn("_step", number)
    # at one moment later steps stand first, so what is carried to them is strictly earlier
    rows = rows.select("_user", "_time", "_step", (-F.col("_step")).alias("_rank"), F.when(F.col("_step") == 1, F.col("_time")).alias("_ok")).distinct()
    order = ["_time", "_rank"]
    with Stages(events.sparkSession) as stages:
        ranged = stages.own(in_ranges(rows, ["_user"], order))
        for k in range(2, len(steps) + 1):
            given = ranged.withColumn("_given", F.when(F.col("_step") == k - 1, F.col("_ok")))
            seen = last_before(given, ["_user"], order, "_given", "_before").drop("_given")
            reached = F.when((F.col("_step") == k) & (F.col("_before") + within >= F.col("_time")), F.col("_time"))
            ranged = stages.own(materialise_buckets(seen.withColumn("_ok", F.coalesce("_ok", reached)).drop("_before"), [RANGE]))
        times = [F.min(F.when(F.col("_step") == k, F.col("_ok"))).alias(f"time_{k}") for k in range(1, len(steps) + 1)]
        found = ranged.groupBy(F.col("_user").alias(user)).agg(*times).filter("time_1 is not null")
        count = sum((F.col(f"time_{k}").isNotNull().cast("int") for k in range(1, len(steps) + 1)), F.lit(0))
        return materialise(found.select(user, count.alias("reached"), *[f"time_{k}" for k in range(1, len(steps) + 1)]))

"""Ordered rows of one entity: neighbours, numbering, running totals and changes.

Raw-grain windows over an entity would put a hot entity into one task; the functions here work range by range (``ranged``), with the results
of the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from .dedup import latest_per_key
from .joins import null_safe_join, with_group_value
from .ranged import along, in_ranges


def with_neighbours(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], previous: Mapping[str, str] = {},
                    following: Mapping[str, str] = {}) -> DataFrame:
    """Add the previous / following row's values: ``{new column: source column}``.

    ``order_cols`` must order the rows of a key fully.
    """
    seen = along(in_ranges(df, keys, order_cols), keys, order_cols, previous=previous, following=following)
    return seen.select(*df.columns, *previous, *following)


def sequence_events(df: DataFrame, entity: str, date: str, tie_break: Sequence[str] = (),
                    number: str = "event_number", following: str = "next_date") -> DataFrame:
    """Number an entity's rows by date and ``tie_break``, and add the next row's date."""
    order = [date, *tie_break]
    ranged = in_ranges(df.withColumn("_one", F.lit(1)), [entity], order)
    seen = along(ranged, [entity], order, {number: "_one"}, following={following: date})
    return seen.select(*df.columns, number, following)


def cumulative_by(df: DataFrame, entity: str, date: str, value: str, acquired: str = "acq_date",
                  out: str = "cum_value") -> DataFrame:
    """Running total per entity from its first date on. Rows are summed per entity and date first, so a window
    group holds one row per date."""
    summed = df.groupBy(entity, date).agg(F.sum(value).alias(value))
    by_entity = W.partitionBy(entity)
    running = by_entity.orderBy(date).rangeBetween(W.unboundedPreceding, W.currentRow)
    return summed.withColumn(acquired, F.min(date).over(by_entity)).withColumn(out, F.sum(value).over(running))


def attribute_history(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value: str) -> DataFrame:
    """First, previous and current value of an attribute along its change history."""
    firsts = with_group_value(df, keys, _f=F.min_by(F.struct(value), F.struct(*order_cols)))
    return with_neighbours(firsts.withColumn(f"first_{value}", F.col("_f")[value]).drop("_f"), keys, order_cols,
                           previous={f"previous_{value}": value})


def detect_increase(history: DataFrame, keys: Sequence[str], value: str, changed: str, created: str,
                    low: int, within_days: int, start_filter, tie_break: Sequence[str] | None = None) -> DataFrame:
    """Entities that start at or below ``low`` and rise above it within ``within_days`` of their creation.

    ``history`` comes from :func:`attribute_history`. The result keeps every starting entity; without a rise its
    change columns are NULL. ``changed`` and ``tie_break`` (default: the value) order the versions of a key.
    """
    starts = latest_per_key(history.filter((F.col(f"first_{value}") <= low) & start_filter), keys, [changed],
                            desc=False, tie_break=tie_break or [value])
    elapsed = F.datediff(F.col(changed), F.col(created))
    rises = (history.filter((F.col(value) > F.col(f"previous_{value}")) & (F.col(value) > low)
                            & (elapsed <= within_days))
                    .select(*keys, F.col(changed), F.col(value).alias(f"current_{value}"),
                            elapsed.alias("days_elapsed")))
    return starts.drop(changed, value, f"previous_{value}").join(rises, list(keys), "left")


def activity_within(starts: DataFrame, facts: DataFrame, keys: Sequence[str], start: str, fact_date: str,
                    days: int, count_of: str, amount: str, count_as: str, amount_as: str) -> DataFrame:
    """Distinct ``count_of`` and summed ``amount`` of the facts in (start, start + days] per start row."""
    right = facts.select(*[F.col(k).alias(f"_f_{k}") for k in keys], F.col(fact_date).alias("_day"),
                         F.col(count_of).alias("_id"), F.col(amount).alias("_amount"))
    # a window of n days touches two blocks of n days: the block is part of the key, so a hot key is cut along time
    block = lambda d: F.floor(F.unix_date(F.to_date(d)) / days)
    right = right.withColumn("_block", block(F.col("_day")))
    left = starts.withColumn("_s_block", F.explode(F.array_distinct(F.array(block(F.date_add(F.col(start), 1)), block(F.date_add(F.col(start), days))))))
    hit = [F.col(k) == F.col(f"_f_{k}") for k in keys] + [F.col("_s_block") == F.col("_block")]
    hit += [F.col("_day") > F.col(start), F.col("_day") <= F.date_add(F.col(start), days)]
    # inner, so that either side of a hot key can be split; starts without a fact come back afterwards
    found = left.join(right, hit).groupBy(*starts.columns).agg(F.countDistinct("_id").alias(count_as), F.sum("_amount").alias(amount_as))
    out = null_safe_join(starts.distinct(), found, starts.columns)
    return out.withColumns({count_as: F.coalesce(count_as, F.lit(0)), amount_as: F.coalesce(amount_as, F.lit(0.0))})


def first_touch_funnel(events: DataFrame, user: str, event: str, time: str, event_id: str, first: str, then: str,
                       first_as: str = "start_time", then_as: str = "reached_time") -> DataFrame:
    """First ``first`` event per user with its id, and the time of the user's first ``then`` event.

    Both come from one aggregation over the two event kinds, so the event table is shuffled once.
    """
    is_first, is_then = F.col(event) == first, F.col(event) == then
    moment = F.struct(F.col(time), F.col(event_id))
    touched = (events.filter(F.col(event).isin(first, then)).groupBy(user)
                     .agg(F.min(F.when(is_first, moment)).alias("_a"), F.min(F.when(is_then, F.col(time))).alias(then_as)))
    return (touched.filter(F.col("_a").isNotNull())
                   .select(user, F.col("_a")[event_id].alias(event_id), F.col("_a")[time].alias(first_as), then_as))


def share_of_groups(counts: DataFrame, count: str, by: Sequence[str] = (), out: str = "share", digits: int | None = None
                    ) -> DataFrame:
    """Each row's share of the total (of its ``by`` group). ``counts`` is an aggregated, small table."""
    share = F.col(count) / F.sum(count).over(W.partitionBy(*by))
    return counts.withColumn(out, share if digits is None else F.round(share, digits))


def conversion_share(first_a: DataFrame, first_b: DataFrame, entity: str, date: str, flag: str = "converted"
                     ) -> DataFrame:
    """Share of the entities of ``first_a`` with a later first date in ``first_b``. One row per entity on each side."""
    later = first_b.select(F.col(entity).alias("_e"), F.col(date).alias("_d"))
    joined = first_a.join(later, (F.col(entity) == F.col("_e")) & (F.col("_d") > F.col(date)), "left")
    counts = joined.groupBy(F.col("_d").isNotNull().alias(flag)).agg(F.countDistinct(entity).alias("n_customers"))
    return share_of_groups(counts, "n_customers")


def cross_share(base: DataFrame, other: DataFrame, entity: str, by: Sequence[str], flag: str, digits: int = 2
                ) -> DataFrame:
    """Share of the base rows whose entity also is in ``other``, per ``by`` group."""
    marks = other.select(F.col(entity).alias("_e")).distinct()
    counts = (base.join(marks, F.col(entity) == F.col("_e"), "left")
                  .groupBy(*by, F.col("_e").isNotNull().alias(flag)).agg(F.count(entity).alias("n_customers")))
    return share_of_groups(counts, "n_customers", by, "share_of_group", digits)


def daily_counts(df: DataFrame, day, dims: Sequence[str], entity: str, count_as: str) -> DataFrame:
    """Distinct entities per day and dimension."""
    return df.groupBy(day.alias("date"), *dims).agg(F.countDistinct(entity).alias(count_as))

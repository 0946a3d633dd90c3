"""Recurring revenue: monthly normalisation, effective end and month snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import date_steps, exact_sum, month_start, next_month_start


def monthly_recurring(amount: str, quantity: str, interval: str, count: str, subunits: Column | str | int = 100
                      ) -> Column:
    """Monthly value of a recurring price in major units; unknown intervals are worth 0."""
    units = F.lit(subunits) if isinstance(subunits, int) else (
        F.col(subunits) if isinstance(subunits, str) else subunits)
    per_period = F.col(amount) * F.col(quantity) / units
    n = F.coalesce(F.col(count), F.lit(1))
    kind = F.col(interval)
    return (F.when(kind == "month", per_period / n)
             .when(kind == "year", per_period / (12 * n))
             .when(kind == "week", per_period * F.lit(52 / 12) / n)
             .when(kind == "day", per_period * F.lit(365 / 12) / n)
             .otherwise(F.lit(0.0)))


def last_paid(invoices: DataFrame, charges: DataFrame) -> DataFrame:
    """Date of the last successful charge per subscription that has one."""
    paid = (charges.filter(F.col("status") == "succeeded")
                   .select(F.col("invoice_id"), F.to_date("created").alias("_paid")))
    linked = invoices.select(F.col("id").alias("invoice_id"), "subscription_id").filter("subscription_id is not null")
    return linked.join(paid, "invoice_id").groupBy("subscription_id").agg(F.max("_paid").alias("last_paid"))


def effective_end(subscriptions: DataFrame, invoices: DataFrame, charges: DataFrame, paid_only: bool = True
                  ) -> DataFrame:
    """Replace ``ended_at``: canceled subscriptions end on their last successful charge.

    ``paid_only`` drops subscriptions without any successful charge.
    """
    paid = last_paid(invoices, charges)
    joined = subscriptions.join(paid, "subscription_id", "inner" if paid_only else "left")
    end = F.coalesce(F.when(F.col("status") == "canceled", F.col("last_paid")), F.col("ended_at"))
    return joined.withColumn("ended_at", end).drop("last_paid")


def month_observations(df: DataFrame, start: str, end: str, value: str, floor, as_of, out: str = "obs_date") -> DataFrame:
    """The rows a month snapshot needs, straight from the intervals: about one per month instead of one per day.

    Every first of month inside [start, end + 1 day] keeps its value (zero after the end). A zero day inside a month
    counts for the next month start: the day after the end, and for worthless intervals every day up to ``as_of``.
    """
    floor_date, last_date = F.lit(floor).cast("date"), F.lit(as_of).cast("date")
    first, tail = F.greatest(F.col(start), floor_date), F.date_add(F.col(end), 1)
    last = F.least(tail, last_date)
    on_or_after = F.when(first == month_start(first), first).otherwise(next_month_start(first))
    firsts = F.coalesce(date_steps(on_or_after, last, "month"), F.array().cast("array<date>"))
    closing = F.when((tail <= last_date) & (tail > month_start(tail)), next_month_start(tail))
    worthless = F.when((tail > last_date) & (F.col(value) == 0) & (last_date > month_start(last_date)), next_month_start(last_date))
    months = F.when(first <= last, F.array_distinct(F.array_compact(F.concat(firsts, F.array(closing, worthless)))))
    return (df.withColumn(out, F.explode(months))
              .withColumn(value, F.when(F.col(end) >= F.col(out), F.col(value)).otherwise(F.lit(0.0))))


def month_snapshot(df: DataFrame, dims: Sequence[str], date_col: str = "obs_date", value: str = "mrr_usd"
                   ) -> DataFrame:
    """Daily values to month starts: first-of-month rows stay, zero rows inside a month move to the next month."""
    day, amount = F.col(date_col), F.col(value)
    on_first = day == month_start(day)
    month = F.when((amount > 0) | on_first, day).otherwise(next_month_start(day))
    return (df.filter(on_first | (amount == 0)).groupBy(*dims, month.alias(date_col))
              .agg(exact_sum(value).alias(value)))

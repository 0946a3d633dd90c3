"""Lifecycle tags, roll-ups, churn and LTV/CAC inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import safe_divide
from .joins import with_group_value

# Label sets.
STATE_LABELS = {"new": "New", "churn": "Churned", "react": "Reactivated", "up": "Expansion",
                "down": "Contraction", "flat": "Retained"}
EVENT_LABELS = {"new": "New", "churn": "Churn", "react": "Reactivation", "up": "Expansion",
                "down": "Contraction", "flat": "Retention"}
SEGMENT_LABELS = {"new": "New", "churn": "Churned", "react": "Reactivated", "up": "MRR Expansion",
                  "down": "MRR Contraction", "flat": "MRR Flat"}


def with_previous(df: DataFrame, entity: Sequence[str], date: str, value: str, tie_break: Sequence[str] = ()
                  ) -> DataFrame:
    """Add ``lagged`` and ``acq_date``. Input has one row per entity and month (or day), so a window group is as
    long as the calendar at most."""
    by_entity = W.partitionBy(*entity)
    return (df.withColumn("lagged", F.lag(value).over(by_entity.orderBy(date, *tie_break)))
              .withColumn("acq_date", F.min(date).over(by_entity)))


def tag_lifecycle(df: DataFrame, entity: Sequence[str], date: str, value: str,
                  labels: Mapping[str, str] = EVENT_LABELS, tie_break: Sequence[str] = (),
                  drop_silent: bool = False) -> DataFrame:
    """Tag every row by comparing its value with the entity's previous one; the first rule that holds decides.

    ``drop_silent`` removes rows that are zero and have no predecessor.
    """
    tagged = with_previous(df, entity, date, value, tie_break)
    if drop_silent:
        tagged = tagged.filter((F.col(value) > 0) | F.col("lagged").isNotNull())
    now, before = F.col(value), F.col("lagged")
    return tagged.withColumn(
        "lifecycle",
        F.when(F.col(date) == F.col("acq_date"), labels["new"])
         .when((now == 0) & (before > 0), labels["churn"])
         .when((now > 0) & (before.isNull() | (before == 0)), labels["react"])
         .when(now > before, labels["up"])
         .when(now < before, labels["down"])
         .when(now == before, labels["flat"]))


def segment(now: Column, before: Column, is_first: Column, labels: Mapping[str, str] = SEGMENT_LABELS) -> Column:
    """Daily-grain tag: a first zero row also counts as churned, the flat test comes before up and down."""
    return (F.when(is_first, labels["new"])
             .when((now == 0) & ((before > 0) | before.isNull()), labels["churn"])
             .when((now > 0) & (before == 0), labels["react"])
             .when(now == before, labels["flat"])
             .when(now > before, labels["up"])
             .when(now < before, labels["down"]))


def tag_segments(df: DataFrame, entity: Sequence[str], date: str, value: str,
                 labels: Mapping[str, str] = SEGMENT_LABELS, tie_break: Sequence[str] = ()) -> DataFrame:
    """Every row with its :func:`segment`."""
    return with_previous(df, entity, date, value, tie_break).withColumn(
        "segment", segment(F.col(value), F.col("lagged"), F.col(date) == F.col("acq_date"), labels))


def tag_stretches(df: DataFrame, entity: str, value: str, part: str, labels: Mapping[str, str] = SEGMENT_LABELS) -> DataFrame:
    """:func:`tag_segments` of the daily rows, with ties broken by ``part``, from stretches of days with one value.

    Stretches of an entity cover the same days or none in common, and have one row per ``part``. The first day of a stretch follows the stretch before, its
    other days follow its own last part; so a stretch gives a row for its first day and one for the rest.
    """
    along = W.partitionBy(entity).orderBy("from_day", part)
    within = W.partitionBy(entity, "from_day").orderBy(part)
    whole = within.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    seen = df.withColumns({"_before": F.lag(value).over(along), "_begin": F.min("from_day").over(W.partitionBy(entity)),
                           "_again": F.when(F.row_number().over(within) == 1, F.last(value).over(whole)).otherwise(F.lag(value).over(within))})
    row = lambda a, b, before, first: F.struct(a.alias("from_day"), b.alias("to_day"), before.alias("lagged"), first.alias("_first"))
    rows = F.array(row(F.col("from_day"), F.col("from_day"), F.col("_before"), F.col("from_day") == F.col("_begin")),
                   row(F.date_add("from_day", 1), F.col("to_day"), F.col("_again"), F.lit(False)))
    parts = seen.withColumn("_row", F.explode(rows)).select(*[c for c in df.columns if c not in ("from_day", "to_day")], "_row.*").filter("from_day <= to_day")
    return parts.withColumn("segment", segment(F.col(value), F.col("lagged"), F.col("_first"), labels)).drop("_first")


def lifecycle_summary(tagged: DataFrame, dims: Sequence[str], entity: str, value: str, count_as: str) -> DataFrame:
    """Distinct entities, current and previous value per dimension set."""
    return tagged.groupBy(*dims).agg(F.countDistinct(entity).alias(count_as),
                                     F.sum(value).alias("current_mrr"), F.sum("lagged").alias("lagged_mrr"))


def tag_status(df: DataFrame, entity: str, date: str, value: str, created: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Customer status against its creation month, with the change of value."""
    now = F.col(value)
    w = W.partitionBy(entity).orderBy(date, *tie_break)
    out = df.withColumn("lagged", F.lag(value).over(w))
    before = F.col("lagged")
    status = (F.when(F.col(date) == F.col(created), "new")
               .when((now == 0) & (before > 0), "churned")
               .when((now > 0) & (F.col(date) > F.col(created)) & (before == 0), "reactivated")
               .when(now > before, "mrr expansion")
               .when(now < before, "mrr contraction")
               .when(now > 0, "mrr flat"))
    return out.withColumn("status", status).withColumn("mrr_delta", now - F.coalesce(before, F.lit(0.0)))


def churn_rates(summary: DataFrame, actives: DataFrame, date: str) -> DataFrame:
    """Churned share of last month's actives, by head count and by value.

    ``summary`` is a month x status table, ``actives`` a month table, so the global window sees only months.
    """
    churned = (summary.filter(F.col("status") == "churned")
                      .select(date, F.col("n").alias("n_churned"), "mrr_delta"))
    w = W.orderBy(date)
    return (churned.join(actives, date)
                   .withColumn("churn_rate", safe_divide(F.col("n_churned"), F.lag("n").over(w)))
                   .withColumn("dollar_churn_rate", safe_divide(-F.col("mrr_delta"), F.lag("mrr_usd").over(w))))


def ltv_cac(lifecycle: DataFrame, margin: DataFrame, dims: Sequence[str], date: str, count: str, suffix: str
            ) -> DataFrame:
    """New, current, churned and base counts and values per (dims, month), joined to the margin inputs."""
    current = (lifecycle.filter(F.col("current_mrr") > 0).groupBy(*dims, date)
               .agg(F.sum(F.when(F.col("lifecycle") == "New", F.col(count)).otherwise(F.lit(0)))
                     .alias(f"n_new_{suffix}"),
                    F.sum("current_mrr").alias("current_mrr"), F.sum(count).alias(f"current_n_{suffix}")))
    churned = (lifecycle.filter(F.col("lifecycle") == "Churn").groupBy(*dims, date)
               .agg(F.sum(count).alias(f"n_churned_{suffix}"), F.sum("lagged_mrr").alias("churned_mrr")))
    w = W.partitionBy(*dims).orderBy(date)
    return (current.join(churned, [*dims, date], "left")
                   .withColumn(f"base_n_{suffix}", F.lag(f"current_n_{suffix}").over(w))
                   .withColumn("base_mrr", F.lag("current_mrr").over(w))
                   .join(margin, [*dims, date], "left"))


def tag_acquisition(df: DataFrame, entity: str, date: str, grace_days: int = 7, acquired: str = "acquisition_date",
                    flag: str = "new_existing", add_date: bool = True) -> DataFrame:
    """First date per entity and a New/Existing flag; NULL first date gives a NULL flag."""
    out = with_group_value(df, [entity], **{acquired: F.min(date)}) if add_date else df
    return out.withColumn(flag, new_or_existing(date, acquired, grace_days))


def new_or_existing(date: str, acquired: str, grace_days: int = 7):
    return (F.when(F.col(date) <= F.date_add(F.col(acquired), grace_days), "New")
             .when(F.col(acquired).isNotNull(), "Existing"))

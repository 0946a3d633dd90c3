"""Days counted by stretches of equal days, against plain windows and sums over one row per day."""

import random

import pytest
from pyspark.sql import Window as W, functions as F

from tillflow.functions import exact_sum, month_start
from tillflow.operators.calendar import expand_intervals
from tillflow.operators.joins import with_group_value
from tillflow.operators.lifecycle import tag_segments
from tillflow.operators.sweep import by_day, stretches
from tillflow.plans import lifecycle, payments

START, AS_OF = "2000-01-05", "2000-04-20"


@pytest.fixture(scope="module")
def intervals(spark):
    """Customers in several regions, without a region or an id; spans without a bound, before the start, after the end, of one day, repeated, worth 0 or null."""
    pick = random.Random(7)
    day = lambda n: f"2000-{1 + n // 28:02d}-{1 + n % 28:02d}"
    rows = []
    for i in range(160):
        a = pick.randrange(0, 130)
        b = a + pick.choice([-3, 0, 1, 2, 9, 30, 60])
        rows.append((pick.choice(["sg", "hk", None]), pick.choice([None, "a", "b", "c", *[f"c{k}" for k in range(12)]]), pick.choice(["x", "y"]), pick.choice(["p", None]),
                     pick.choice([day(a)] * 9 + [None]), pick.choice([day(max(b, 0))] * 9 + [None]), pick.choice([0.0, 1.25, 2.5, 7.0, None])))
    rows += rows[:5]
    frame = spark.createDataFrame(rows, "region string, customer_id string, product_name string, condition string, created_at string, ended_at string, mrr_usd double")
    return frame.withColumns({"created_at": F.to_date("created_at"), "ended_at": F.to_date("ended_at")}).cache()


@pytest.fixture(scope="module")
def daily(intervals):
    """The rows of the daily hub."""
    days = expand_intervals(intervals, "created_at", "ended_at", "obs_date", START, AS_OF, tail_days=1)
    return days.withColumn("mrr_usd", F.when(F.col("ended_at") >= F.col("obs_date"), F.col("mrr_usd")).otherwise(F.lit(0.0))).cache()


def same(got, wanted):
    order = lambda df: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*wanted.columns).collect()), key=repr)
    assert order(wanted) and order(got) == order(wanted)


def customers(daily):
    return daily.groupBy("region", "customer_id", "obs_date").agg(exact_sum("mrr_usd").alias("mrr_usd"))


def test_stretches_hold_every_day_once(intervals):
    keys = ["customer_id", "product_name"]
    known = intervals.filter("created_at is not null and ended_at is not null")
    cut = stretches(known, keys, F.col("created_at"), F.col("ended_at"), by=["region"], v=F.sum("mrr_usd"), n=F.count(F.lit(1)))
    plain = known.withColumn("day", F.explode(F.expr("if(created_at <= ended_at, sequence(created_at, ended_at), array())")))
    same(by_day(cut, "1900-01-01", "2100-01-01"), plain.groupBy(*keys, "region", "day").agg(F.sum("mrr_usd").alias("v"), F.count(F.lit(1)).alias("n")))


def test_churn_rate_is_that_of_the_days(intervals, daily):
    counts = customers(daily).groupBy("region", "obs_date").agg(F.countDistinct(F.when(F.col("mrr_usd") == 0, F.col("customer_id"))).alias("n_churned"),
                                                                F.countDistinct("customer_id").alias("n_customers"))
    wanted = counts.withColumn("lagged_n_customers", F.lag("n_customers").over(W.partitionBy("region").orderBy("obs_date")))
    same(lifecycle.churn_rate(payments.customer_levels(payments.valued_spans(intervals, AS_OF, START)), AS_OF, START), wanted)


def test_segments_are_those_of_the_days(intervals, daily):
    tagged = tag_segments(customers(daily), ["customer_id"], "obs_date", "mrr_usd", tie_break=["region"])
    counts = tagged.groupBy("region", "obs_date", "segment").agg(F.countDistinct("customer_id").alias("n_customers"), F.count(F.when(F.col("mrr_usd") > 0, 1)).alias("n_paying"),
                                                                 F.sum("mrr_usd").alias("mrr_usd"), F.sum("lagged").alias("lagged_mrr"))
    wanted = counts.withColumn("lagged_n_customers", F.lag("n_customers").over(W.partitionBy("region", "segment").orderBy("obs_date")))
    same(lifecycle.customer_segments(payments.customer_levels(payments.valued_spans(intervals, AS_OF, START)), AS_OF, START), wanted)


def test_monthly_subs_are_those_of_the_days(intervals, daily):
    day = F.when(F.col("mrr_usd") == 0, F.date_add(F.last_day("obs_date"), 1)).otherwise(F.col("obs_date"))
    keys = ["customer_id", "product_name", "country", "condition"]
    days = daily.withColumn("country", F.col("region")).groupBy(day.alias("day"), *keys).agg(F.sum("mrr_usd").alias("mrr"), F.min(month_start("created_at")).alias("made"))
    monthly = days.groupBy(month_start("day").alias("obs_date"), *keys).agg((F.sum("mrr") / F.count(F.lit(1))).alias("mrr"), F.min("made").alias("made"))
    dated = with_group_value(monthly, ["customer_id"], acq_date=F.min("made")).drop("made")
    wanted = dated.withColumn("mrr_lagged", F.coalesce(F.lag("mrr").over(W.partitionBy(*keys).orderBy("obs_date")), F.lit(0.0)))
    same(lifecycle.monthly_subs(payments.valued_spans(intervals, AS_OF, START)), wanted)


def test_days_are_listed_last(spark):
    from conftest import SF

    from tillflow.session import tuned
    from tillflow.testbed.tables import ShopTables
    shop = ShopTables(tuned(spark), SF)
    plan = payments.customer_metrics(shop, "2001-06-30", "1995-01-01")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and not any(node in plan.split("Generate explode")[0] for node in ("Aggregate", "Join"))
    spans = payments.valued_spans(payments.subscription_intervals(shop), "2001-06-30", "1995-01-01")
    for frame in (payments.customer_levels(spans), lifecycle.monthly_subs(spans)):
        assert "INTERVAL '1' DAY" not in frame._jdf.queryExecution().optimizedPlan().toString().upper()

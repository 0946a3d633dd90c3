"""Values that a job repeats over days are rounded and formatted once an interval."""

import datetime

from conftest import SF
from pyspark.sql import functions as F

from tillflow.catalog import PLAIN, QUERIES
from tillflow.catalog.registry import _shown
from tillflow.plans import payments


def test_metrics_are_rounded_before_their_days_are_listed(spark):
    plan = QUERIES["JB2_subscription_metrics"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode")
    assert "round(" not in above and "round(" in below
    shown = _shown(PLAIN["JB2_subscription_metrics"](spark, SF), {"mrr_local": 6, "mrr_usd": 6})
    got = QUERIES["JB2_subscription_metrics"](spark, SF)
    assert got.dtypes == shown.dtypes
    assert got.count() > 0 and got.exceptAll(shown).isEmpty() and shown.exceptAll(got).isEmpty()


def test_days_of_odd_intervals_are_the_same_when_shown_early(spark, monkeypatch):
    day = datetime.date
    spans = spark.createDataFrame([
        ("sg", "a", day(2000, 1, 30), day(2000, 2, 2), 1.00000049, 2.0), ("sg", "a", day(2000, 1, 30), day(2000, 2, 2), 1.00000049, 2.0),
        ("hk", None, day(1999, 12, 1), day(2000, 1, 1), -0.0, None), (None, "c", None, day(2000, 1, 1), 1.0, 1.0), ("jp", "d", day(2000, 1, 5), None, 1.0, 1.0),
        ("jp", "e", day(2000, 2, 9), day(2000, 2, 3), 1.0, 1.0)],
        "region string, subscription_id string, created_at date, ended_at date, mrr_local double, mrr_usd double")
    rest = ["customer_id", "currency", "plan_id", "plan_interval", "interval_count", "product_id", "product_name", "n_boxes", "condition"]
    monkeypatch.setattr(payments, "subscription_intervals", lambda t: spans.withColumns({c: F.lit("x") for c in rest}))
    show = lambda df: _shown(df, {"mrr_local": 6, "mrr_usd": 6})
    key = lambda r: str(tuple(r))
    for step in ("day", "month"):
        late = show(payments.subscription_metrics({}, "2000-02-02", "2000-01-01", step)).collect()
        early = payments.subscription_metrics({}, "2000-02-02", "2000-01-01", step, show).collect()
        assert late and sorted(early, key=key) == sorted(late, key=key)

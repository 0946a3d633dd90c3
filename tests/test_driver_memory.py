"""What is held on the driver and in one task: broadcast sizes, calendars filled without moving their zero rows."""

from conftest import SF
from pyspark.sql import functions as F

from tillflow.operators.calendar import zero_fill
from tillflow.plans import finance, payments
from tillflow.session import tuned
from tillflow.sources.writers import materialise
from tillflow.testbed.tables import ShopTables


def test_a_table_with_small_files_is_not_broadcast_whole(spark):
    session = tuned(spark)
    prices = materialise(session.range(300_000).select(F.concat(F.lit("price_"), "id").alias("price_id"), F.concat(F.lit("Product of a long name "), F.col("id") % 50).alias("name")))
    lines = materialise(session.range(900_000).select(F.concat(F.lit("price_"), F.col("id") % 300_000).alias("price_id"), "id"))
    joined = lines.join(prices, "price_id", "left").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    assert joined.agg(F.sum("n")).first()[0] == 900_000
    assert joined.collect()[0].n == 18_000
    # the plan as run, after the sizes were measured
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def test_zero_months_are_neither_moved_nor_aggregated(spark):
    rows = spark.createDataFrame([("a", "2000-01-05", 1.0), ("a", "2000-01-09", 2.0), ("a", "2000-04-01", None), ("a", "2000-07-01", 5.0),
                                  (None, "2000-05-02", 4.0), ("b", None, 7.0), ("c", "2000-08-01", None)], "k string, d string, v double").withColumn("d", F.to_date("d"))
    filled = zero_fill(rows, ["k"], "d", "v", end="2000-05-20", floor="2000-01-01")
    assert sorted(((r.k or "", str(r.d), r.v) for r in filled.collect()), key=str) == sorted([
        ("a", "2000-01-01", 3.0), ("a", "2000-02-01", 0.0), ("a", "2000-03-01", 0.0), ("a", "2000-04-01", 0.0), ("a", "2000-05-01", 0.0), ("a", "2000-07-01", 5.0),
        ("", "2000-05-01", 4.0), *[("b", f"2000-0{m}-01", 0.0) for m in range(1, 6)], ("b", "None", 7.0), ("c", "2000-08-01", None)], key=str)
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    # the explode is the last step: nothing above it groups its rows
    assert "Aggregate" not in plan.split("Generate explode")[0]


def test_charge_history_explodes_after_its_last_shuffle(spark):
    plan = payments.charge_history(ShopTables(tuned(spark), SF), "2001-06-30", "1995-01-01")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Aggregate" not in plan.split("Generate explode")[0]


def test_the_hub_moves_its_wide_lines_once(spark):
    """Prices, costs and lines are joined by the line's price; starts of subscriptions before the lines fan out."""
    plan = finance.contribution_margin(ShopTables(tuned(spark), SF))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    line = next(i for i, text in enumerate(plan) if "Join LeftOuter" in text and "_rg_price_id" in text and "line_price" in text)
    assert not any("subscription_created_date" in text for text in plan[line + 1:line + 2])
    assert not any("px_price" in text and "_rg_price_id" in text for text in plan)


def test_the_hub_plans_its_channels_one_by_one(spark):
    """Of the channels only the cards are left in the plan of the hub: the others are read as they were staged."""
    plan = finance.contribution_margin(ShopTables(tuned(spark), SF))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 15
    assert not any(sheet in plan for sheet in ("buyer_username", "username_buyer_", "seller_sku", "atome_order_id", "awb_no"))


def test_first_of_month_rows_need_no_daily_rows(spark):
    shop = ShopTables(tuned(spark), SF)
    daily = payments.subscription_metrics(shop, "2001-06-30", "1995-01-01").filter(F.dayofmonth("obs_date") == 1)
    firsts = payments.subscription_metrics(shop, "2001-06-30", "1995-01-01", step="month")
    assert firsts.count() > 0 and firsts.exceptAll(daily).isEmpty() and daily.exceptAll(firsts).isEmpty()

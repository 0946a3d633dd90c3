"""Jobs on literal tables whose results are worked out by hand, plans, and the order of sorted results."""

from datetime import date, datetime

import pytest
from conftest import SF, rows

from tillflow.catalog import PLAIN
from tillflow.plans import finance, payments
from tillflow.session import tuned


def frame(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


@pytest.fixture(scope="module")
def shop(spark):
    """A shop with one product, three charges (one by a guest, one in a currency without subunits) and one plan change within a day."""
    moment = lambda h: datetime(2024, 1, 5, h)
    return {
        "fx": frame(spark, "currency string, fx_to_usd double", ("sgd", 2.0), ("jpy", 100.0)),
        "subunits": frame(spark, "currency string, subunits int", ("sgd", 100), ("jpy", 1)),
        "charge": frame(spark, "id string, region string, created timestamp, customer_id string, status string, amount bigint, currency string, invoice_id string,"
                        "payment_intent_id string", ("c1", "sg", moment(9), "cus", "succeeded", 1000, "sgd", None, "p1"),
                        ("c2", "sg", moment(10), None, "succeeded", 400, "sgd", None, "p2"), ("c3", "jp", moment(11), "cus", "succeeded", 700, "jpy", None, "p3")),
        "payment_intent": frame(spark, "id string, metadata string", *[(f"p{i}", "{}") for i in (1, 2, 3)]),
        "invoice_line_item": frame(spark, "invoice_id string, subscription_id string, price_id string, quantity bigint, amount bigint, plan_id string",
                                   ("i1", "s", None, 1, 1, "long"), ("i2", "s", None, 1, 1, "short")),
        "price": frame(spark, "id string, product_id string, unit_amount bigint, recurring_interval string, recurring_interval_count bigint", ("x", "prod", 1, None, None)),
        "product": frame(spark, "id string, name string, metadata string, active boolean", ("prod", "Kit", '{"condition": "[Sample] kit"}', True)),
        "plan": frame(spark, "id string, plan_interval string, product_id string, interval_count bigint", ("long", "month", "prod", 6), ("short", "month", "prod", 1)),
        "subscription_history": frame(spark, "id string, region string, status string, created timestamp, valid_from timestamp, latest_invoice_id string",
                                      ("s", "sg", "active", moment(1), moment(8), "i1"), ("s", "sg", "active", moment(1), moment(20), "i2")),
    }


def test_guest_charges_are_kept(shop):
    got = payments.charge_history(shop, "2024-01-31", "2024-01-01").filter("amount <> 0")
    assert rows(got.selectExpr("coalesce(customer_id, 'guest') as who", "region", "amount"), "who", "region", "amount") == [
        ("cus", "jp", 7.0), ("cus", "sg", 5.0), ("guest", "sg", 2.0)]


def test_a_move_to_a_shorter_interval_within_a_day_is_no_rise(shop):
    assert payments.interval_changes(shop).count() == 0


def test_a_rise_within_a_day_is_found(spark, shop):
    turned = dict(shop, invoice_line_item=frame(spark, shop["invoice_line_item"].schema, ("i1", "s", None, 1, 1, "short"), ("i2", "s", None, 1, 1, "long")))
    got = payments.interval_changes(turned)
    assert rows(got, "first_interval_count", "current_interval_count", "days_elapsed", "condition") == [(1, 6, 0, "[Sample] kit")]


def test_costs_of_every_region(spark):
    sheet = frame(spark, "region string, id string, cost_box double, packaging_cost double, effective_date date",
                  ("sg", "p", 1.0, 0.1, date(2024, 1, 1)), ("th", "p", 3.0, 0.1, date(2024, 1, 1)), ("th", "p", 4.0, 0.1, date(2024, 6, 1)))
    got = finance.product_cost_per_box(sheet)
    assert rows(got, "region", "cost_box", "to_date") == [("sg", 1.0, date(9999, 12, 31)), ("th", 3.0, date(2024, 5, 31)), ("th", 4.0, date(9999, 12, 31))]


def test_both_margins_agree_on_the_cost_of_goods(spark):
    by_charge = PLAIN["JB46_cm3"](spark, SF).filter("condition <> 'Services'").groupBy("country", "purchase_month").sum("cogs").collect()
    by_month = PLAIN["JB60_monthly_contribution_margin"](spark, SF).filter("condition <> 'Services'").groupBy("country", "date").sum("cogs").collect()
    left, right = ({(r[0], r[1]): r[2] or 0.0 for r in x} for x in (by_charge, by_month))
    assert set(left) == set(right) and all(left[k] == pytest.approx(right[k], abs=1e-6) for k in left)


@pytest.mark.parametrize("name", ["JN8_effective_dated", "JN24_constant_key", "CMP4_asof_range_join", "JB52_contribution_margin", "JB11_cumulative_revenue", "JB64_subscription_renewals"])
def test_no_nested_loop(spark, name):
    name = next(n for n in PLAIN if n.split("_")[0] == name.split("_")[0])
    plan = PLAIN[name](spark, SF)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name,key", [
    ("SRT1_order_by", lambda r: (r.o_custkey, r.o_orderkey)), ("SRT2_mixed_order", lambda r: (r.p_type, -r.p_size)),
    ("SRT4_arrange", lambda r: (r.c_mktsegment, r.c_custkey)), ("JB31_rx_vs_otc", lambda r: (r.region, not r.has_otc)),
    ("JB14_customer_purchase_history", lambda r: (r.customer_id is not None, r.customer_id or "", r.purchase_date, r.purchase_number)),
    ("JB39_upgrade_intent", lambda r: (r.region, -r.date.toordinal())), ("JB56_ltv_cac", lambda r: (r.region, r.obs_date)),
    ("JB65_tax_rate_history", lambda r: (r.region, r.from_date))])
def test_order_of_sorted_results(spark, name, key):
    got = [key(r) for r in PLAIN[name](spark, SF).collect()]
    assert len(got) > 3 and got == sorted(got)


def test_the_callers_session_stays_as_it_is(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        inner = tuned(spark)
        assert inner.conf.get("spark.sql.adaptive.enabled") == "true" and spark.conf.get("spark.sql.adaptive.enabled") == "false"
        PLAIN["AGG1_group_by"](spark, SF).count()
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")

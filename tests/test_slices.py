"""Large tables worked slice by slice: the same rows, and nothing left behind but the result."""

import datetime

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tillflow.catalog import ORACLES, QUERIES
from tillflow.operators import distinct
from tillflow.plans import finance, marketing
from tillflow.session import tuned
from tillflow.sources import writers
from tillflow.testbed import tables
from tillflow.testbed.tables import ShopTables

# hubs made in slices, for the jobs here alone
HUBS: dict = {}


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(writers, "SLICE_BYTES", 1)
    monkeypatch.setattr(writers, "MOST_SLICES", 2)


def shown(df):
    kinds = dict(df.dtypes)
    return sorted(map(repr, df.select(*[F.round(c, 6).alias(c) if kinds[c] == "double" else c for c in df.columns]).collect()))


def staged(session):
    return set(writers._staged(session))


def test_a_slice_holds_whole_keys(spark):
    df = spark.createDataFrame([(i % 7 or None, i) for i in range(100)], "k int, v int")
    parts = [df.filter(writers.in_slice(k, 4, "k")).collect() for k in range(4)]
    assert sorted(r.v for p in parts for r in p) == list(range(100))
    assert sum(len({r.k for r in p}) for p in parts) == 7


def test_order_lines_in_slices(spark, small_slices, monkeypatch):
    shop = ShopTables(tuned(spark), SF)
    before = staged(shop.spark)
    sliced = finance.contribution_margin(shop)
    # one folder with all lines; charges, prices and the other steps are gone
    assert writers.is_table(sliced) and staged(shop.spark) - before == set(writers.staged_paths(sliced))
    monkeypatch.setattr(writers, "SLICE_BYTES", 1 << 40)
    whole = finance.contribution_margin(shop)
    assert sliced.columns == whole.columns and shown(sliced) == shown(whole)


@pytest.mark.parametrize("name", ["CMP29_normalize_sales", "JB20_monthly_revenue_by_customer", "JB46_cm3", "JB59_marketing_spend", "JB60_monthly_contribution_margin",
                                  "JB73_pnl_metrics"])
def test_jobs_in_slices_match_their_twins(spark, small_slices, monkeypatch, name):
    monkeypatch.setattr(tables, "_HUB_PATHS", HUBS)
    if name == "JB59_marketing_spend":
        shop = ShopTables(tuned(spark), SF)
        assert shown(marketing.staged_spend(shop)) == shown(marketing.marketing_spend(shop))
        return
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for table in tables.BASE:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    twin = con.execute(f"select {', '.join(sorted(got.columns))} from ({ORACLES[name]}) as x").fetchall()
    assert got.count() > 0 and sorted(map(repr, twin)) == sorted(repr(tuple(r)) for r in got.select(*sorted(got.columns)).collect())


def test_pools_do_not_move_the_charges(spark, monkeypatch):
    """The pools are a small staged table when the charges meet them."""
    shop = ShopTables(tuned(spark), SF)
    hub = writers.materialise(shop.spark.createDataFrame([("Stripe", "sg", datetime.date(2000, 1, 5), "One-Time", None, "manual", "ED", "sgd", f"c{i % 9}", f"ch{i}", None, None, 0.07, 3.0,
                                                           None, 1.0, 2, 0.1, 0.0, 0.02, 0.0) for i in range(50)],
                                                         "sales_channel string, region string, purchase_date date, purchase_type string, new_existing string, billing_reason string, condition string, "
                                                         "currency string, customer_id string, charge_id string, recurring_interval string, recurring_interval_count long, gst_vat double, "
                                                         "line_item_amount_usd double, total_charge_amount_usd double, cogs double, quantity long, packaging double, cashback double, fee_rate double, "
                                                         "amount_refunded_usd double"))
    spend = shop.spark.createDataFrame([(datetime.date(2000, 1, 9), "SG", "ED", 12.0)], "date date, country_code string, condition string, cost_usd double")
    for margin, rows in ((finance.cm3(hub, spend, shop), 50), (finance.monthly_contribution_margin(hub, spend, shop), 9)):
        assert margin.count() == rows
        plan = margin._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan


def test_distinct_counts_in_slices(spark, small_slices):
    rows = writers.materialise(spark.createDataFrame([(g, e) for g, e in [("a", 1), ("a", 1), ("a", 2), (None, 1), (None, None), ("b", None), ("c", 3)] for _ in range(2)], "g string, e int"))
    assert sorted(map(tuple, distinct.count_distinct_by(rows, ["g"], "e").collect()), key=repr) == sorted([("a", 2), (None, 1), ("b", 0), ("c", 1)], key=repr)

"""Scans, sinks, projections and filters."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, functions as F

from ..functions import map_channel, month_start, typed_null
from ..operators.dedup import latest_per_key
from ..sources.readers import Tables, read_csv, read_sheet_range, read_snapshot, run_query_file
from ..sources.regions import region_union
from ..sources.writers import publish_view, write_batches, write_snapshot
from ..plans import payments
from .registry import query, scratch

REGIONS = ("sg", "hk", "jp")


def by_region(df):
    return {r: df.filter(F.col("region") == r).drop("region") for r in REGIONS}


@query("SRC1_table_scan", "select o_orderkey, o_custkey, o_totalprice from orders", r2="o_totalprice")
def _(s):
    return Tables(s.spark, s.sf_dir, ["orders"])["orders"].select("o_orderkey", "o_custkey", "o_totalprice")


@query("SRC2_view_scan", "select region, count(*) as n, sum(amount)::bigint as amount from t_charge where status = 'succeeded' group by 1")
def _(s):
    publish_view(payments.succeeded(s), "paid_charges")
    return s.spark.table("paid_charges").groupBy("region").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


# every payment table: the test table that stands for it, and a test on its columns
PAYMENT_VIEWS = {
    "subscription_history": ("subscription_history", "ended_at is not null"), "subscription_item": ("regional_subscription_item", "quantity > 1"),
    "charge": ("charge", "amount > 1000"), "plan": ("plan", "amount > 1000"), "invoice": ("invoice", "subtotal > 1000"), "product": ("product", "active"),
    "invoice_item": ("invoice_item", "amount > 1000"), "payment_intent": ("payment_intent", "metadata <> '{}'"), "price": ("price", "unit_amount > 1000"),
    "invoice_line_item": ("regional_invoice_line_item", "quantity > 10"), "customer": ("customer", "email is not null"),
    "balance_transaction": ("balance_transaction", "fee > 100")}


def payment_union(s):
    """All twelve payment views out of regional frames; the listed columns that a test table lacks are empty in it."""
    def frames(name):
        df = s[PAYMENT_VIEWS[name][0]]
        missing = [c for c in payments.PAYMENT_COLUMNS.get(name, []) if c not in df.columns]
        return by_region(df.withColumns({c: typed_null("string") for c in missing}))
    return payments.payment_views({name: frames(name) for name in PAYMENT_VIEWS})


@query("SRC3_region_union_payments", " union all ".join(
    f"select '{n}' as source, region, count(*) as n, count(*) filter (where {test}) as n_tested from t_{table} group by 2"
    for n, (table, test) in PAYMENT_VIEWS.items()))
def _(s):
    union = payment_union(s)
    return reduce(DataFrame.unionByName, [
        union[n].groupBy(F.lit(n).alias("source"), "region").agg(F.count("*").alias("n"), F.count_if(F.expr(test)).alias("n_tested"))
        for n, (_, test) in PAYMENT_VIEWS.items()])


@query("SRC4_region_union_application", "select id, region, status from t_appointment")
def _(s):
    return region_union(by_region(s["appointment"]), ["id", "status"]).select("id", "region", "status")


@query("SRC5_csv_read", "select s_suppkey, s_name, s_acctbal from supplier", r2="s_acctbal")
def _(s):
    path = scratch(s, "csv")
    s.base("supplier").select("s_suppkey", "s_name", "s_acctbal").write.csv(path, header=True)
    return read_csv(s.spark, path, "s_suppkey bigint, s_name string, s_acctbal double")


@query("SRC6_sheet_range", "select c_custkey, c_name from customer")
def _(s):
    path = scratch(s, "sheet")
    titled = s.base("customer").select(F.col("c_custkey").cast("string"), "c_name").unionByName(
        s.base("region").select(F.lit("").alias("c_custkey"), F.lit("blank row").alias("c_name")))
    titled.write.csv(path, header=True)
    return read_sheet_range(s.spark, path, "c_custkey bigint, c_name string", "c_custkey")


@query("SRC7_snapshot", "select p_partkey, p_brand, p_retailprice from part", r2="p_retailprice")
def _(s):
    path = scratch(s, "snapshot")
    write_snapshot(s.base("part").select("p_partkey", "p_brand", "p_retailprice"), path)
    return read_snapshot(s.spark, path)


@query("SRC8_query_file", """select c_nationkey, count(*) as n_orders, sum(o_totalprice) as revenue from orders join customer
 on o_custkey = c_custkey where o_orderdate >= date '1997-01-01' group by 1""", r2="revenue")
def _(s):
    return run_query_file(s.spark, str(Path(__file__).parent / "sql" / "nation_revenue.sql"), {"since": "1997-01-01"},
                          orders=s.base("orders"), customer=s.base("customer"))


@query("SRC9_query_parameter", "select distinct creative_id from t_fb_ad where created_time >= date '2001-05-01'")
def _(s):
    return s.spark.sql("SELECT DISTINCT creative_id FROM {ads} WHERE created_time >= CAST(:since AS DATE)",
                       args={"since": "2001-05-01"}, ads=s["fb_ad"])


@query("SRC10_generated_calendar", """select o_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)),
 date_trunc('month', max(o_orderdate)), interval 1 month))::date as month from orders group by 1""", dates="month")
def _(s):
    span = s.base("orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return span.select("o_custkey", F.explode(F.sequence(month_start("a"), month_start("b"), F.expr("interval 1 month"))).alias("month"))


@query("SNK1_view_sink", "select p_brand, count(*) as n from part group by 1")
def _(s):
    publish_view(s.base("part").groupBy("p_brand").agg(F.count("*").alias("n")), "brand_counts")
    return s.spark.sql("SELECT * FROM brand_counts")


@query("SNK2_numbered_batches", """select c_custkey, c_name, floor((row_number() over (order by c_mktsegment, c_custkey) - 1) / 400)::bigint + 1
 as batch from customer""")
def _(s):
    path = scratch(s, "batches")
    write_batches(s.base("customer").select("c_mktsegment", "c_custkey", "c_name"), ["c_mktsegment", "c_custkey"], 400, path)
    rows = s.spark.read.csv(path, header=True, schema="c_mktsegment string, c_custkey bigint, c_name string, batch bigint")
    return rows.select("c_custkey", "c_name", "batch")


@query("SNK3_table_export", "select n_nationkey, n_name from nation")
def _(s):
    path = scratch(s, "export")
    s.base("nation").select("n_nationkey", "n_name").write.mode("overwrite").csv(path, header=True)
    return read_csv(s.spark, path, "n_nationkey int, n_name string")


@query("SNK4_rolling_extract", "select o_orderkey, o_orderdate from orders where o_orderdate >= date '2001-06-30' - interval 3 month",
       stamps="o_orderdate")
def _(s):
    path = scratch(s, "rolling")
    since = F.add_months(F.lit("2001-06-30").cast("date"), -3)
    write_snapshot(s.base("orders").filter(F.col("o_orderdate") >= since).select("o_orderkey", "o_orderdate"), path)
    return read_snapshot(s.spark, path)


# --- projections ----------------------------------------------------------------------------------------------------
@query("PRJ1_projection", "select l_orderkey as order_id, l_partkey as part_id, l_quantity as qty from lineitem", r2="qty")
def _(s):
    return s.base("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id"), F.col("l_quantity").alias("qty"))


@query("PRJ2_star_plus", "select *, s_acctbal > 0 as in_credit from supplier", r2="s_acctbal")
def _(s):
    return s.base("supplier").select("*", (F.col("s_acctbal") > 0).alias("in_credit"))


@query("PRJ3_star_except", "select * exclude (p_name, p_type) from part", r2="p_retailprice")
def _(s):
    return s.base("part").drop("p_name", "p_type")


@query("PRJ4_literals", "select c_custkey, 'main' as metric_type, 0 as reach from customer")
def _(s):
    return s.base("customer").select("c_custkey", F.lit("main").alias("metric_type"), F.lit(0).alias("reach"))


@query("PRJ5_typed_nulls", """select s_suppkey, null::varchar as email, null::varchar as since from supplier""")
def _(s):
    return s.base("supplier").select("s_suppkey", typed_null("string").alias("email"), typed_null("date").alias("since"))


@query("PRJ6_null_test_flag", "select sys_id, prescription_id is not null as has_prescription from t_app_order")
def _(s):
    return s["app_order"].select("sys_id", F.col("prescription_id").isNotNull().alias("has_prescription"))


@query("PRJ7_case", """select o_orderkey, case when o_totalprice >= 400000 then 'large' when o_totalprice >= 100000 then 'medium'
 else 'small' end as size from orders""")
def _(s):
    v = F.col("o_totalprice")
    return s.base("orders").select("o_orderkey", F.when(v >= 400000, "large").when(v >= 100000, "medium").otherwise("small").alias("size"))


@query("PRJ8_prefix_ladder", """select event_id, case when starts_with(props, '{"k": 1') then 'one' when starts_with(props, '{"k": 2') then 'two'
 else props end as bucket from events""")
def _(s):
    return s.base("events").select("event_id", map_channel("props", [('{"k": 1', "one"), ('{"k": 2', "two")]).alias("bucket"))


@query("PRJ9_contains_ladder", """select page_id, case when contains(url, 'utm_source') then 'campaign' when contains(url, '.com') then 'com'
 when contains(url, '.net') then 'net' else url end as kind from pages""")
def _(s):
    return s.base("pages").select("page_id", map_channel("url", [("utm_source", "campaign"), (".com", "com"), (".net", "net")],
                                                         match="contains").alias("kind"))


@query("PRJ10_rename", "select c_name as name, c_custkey as id from customer")
def _(s):
    return s.base("customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))


@query("PRJ11_arithmetic", "select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) as charge, -l_quantity as minus_qty from lineitem",
       r6="charge minus_qty")
def _(s):
    c = F.col
    return s.base("lineitem").select("l_orderkey", "l_linenumber", (c("l_extendedprice") * (1 - c("l_discount")) * (1 + c("l_tax"))).alias("charge"),
                                     (-c("l_quantity")).alias("minus_qty"))


# --- filters --------------------------------------------------------------------------------------------------------
@query("FLT1_equality", "select o_orderkey from orders where o_orderstatus = 'F' and o_orderpriority = '2-HIGH'")
def _(s):
    return s.base("orders").filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")).select("o_orderkey")


@query("FLT2_or_group", "select l_orderkey, l_linenumber from lineitem where l_quantity > 48 or l_discount > 0.09 or l_returnflag = 'R'")
def _(s):
    c = F.col
    return s.base("lineitem").filter((c("l_quantity") > 48) | (c("l_discount") > 0.09) | (c("l_returnflag") == "R")).select("l_orderkey", "l_linenumber")


@query("FLT3_date_range", "select l_orderkey from lineitem where l_shipdate >= date '1996-01-01' and l_shipdate < date '1996-04-01'")
def _(s):
    d = F.col("l_shipdate")
    return s.base("lineitem").filter((d >= F.lit("1996-01-01").cast("date")) & (d < F.lit("1996-04-01").cast("date"))).select("l_orderkey")


@query("FLT4_relative_time", "select message_id from t_tracks where ts >= timestamp '1999-01-20 12:00:00' - interval 24 hour")
def _(s):
    as_of = F.lit("1999-01-20 12:00:00").cast("timestamp_ntz")
    return s["tracks"].filter(F.col("ts") >= as_of - F.expr("interval 24 hours")).select("message_id")


@query("FLT5_first_of_month", "select o_orderkey from orders where o_orderdate = date_trunc('month', o_orderdate)")
def _(s):
    day = F.to_date("o_orderdate")
    return s.base("orders").filter(day == month_start(day)).select("o_orderkey")


@query("FLT6_in_list", "select p_partkey from part where p_type in ('PROMO', 'LARGE')")
def _(s):
    return s.base("part").filter(F.col("p_type").isin("PROMO", "LARGE")).select("p_partkey")


@query("FLT7_not_in_list", "select message_id from t_page_event where context_campaign_source not in ('fb', 'bing')")
def _(s):
    return s["page_event"].filter(~F.col("context_campaign_source").isin("fb", "bing")).select("message_id")


@query("FLT8_null_tests", """select id, invoice_id is null as no_invoice from t_charge where customer_id is not null""")
def _(s):
    return s["charge"].filter(F.col("customer_id").isNotNull()).select("id", F.col("invoice_id").isNull().alias("no_invoice"))


@query("FLT9_is_false", "select id from t_refresh_task where deleted is false")
def _(s):
    return s["refresh_task"].filter(F.col("deleted").eqNullSafe(False)).select("id")


@query("FLT10_like", "select id, name from t_product where lower(name) like '%tele%' or name like 'red%'")
def _(s):
    return s["product"].filter(F.lower("name").like("%tele%") | F.col("name").like("red%")).select("id", "name")


@query("FLT11_null_or_empty", "select id from t_invoice where subscription_id is null or subscription_id = ''")
def _(s):
    return s["invoice"].filter(F.col("subscription_id").isNull() | (F.col("subscription_id") == "")).select("id")


@query("FLT12_having", "select o_custkey, sum(o_totalprice) as total from orders group by 1 having sum(o_totalprice) > 2500000", r2="total")
def _(s):
    return s.base("orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total")).filter(F.col("total") > 2500000)


@query("FLT13_post_window", """select o_custkey, o_orderkey from orders
 qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""")
def _(s):
    return latest_per_key(s.base("orders"), ["o_custkey"], ["o_orderdate"], tie_break=["o_orderkey"]).select("o_custkey", "o_orderkey")


@query("FLT14_on_predicates", """select c_custkey, count(o_orderkey) as n_open from customer left join orders on o_custkey = c_custkey
 and o_orderstatus = 'O' and c_mktsegment = 'BUILDING' group by 1""")
def _(s):
    opened = s.base("orders").filter(F.col("o_orderstatus") == "O")
    on = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("c_mktsegment") == "BUILDING")
    return s.base("customer").join(opened, on, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_open"))


@query("FLT15_drop_missing", "select message_id, context_campaign_medium from t_page_event where context_campaign_medium is not null")
def _(s):
    return s["page_event"].dropna(subset=["context_campaign_medium"]).select("message_id", "context_campaign_medium")

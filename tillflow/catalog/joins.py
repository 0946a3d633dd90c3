"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import date_steps, json_scalar, month_start, regex_group
from ..operators.calendar import expand_intervals
from ..operators.joins import anti_join, with_group_value
from ..operators.metrics import merge_metrics, reconcile
from ..operators.ranges import asof_range_join
from ..operators.sequence import activity_within
from ..plans import finance
from .registry import query

c = F.col


@query("JN1_inner", "select o_orderkey, c_name from orders join customer on o_custkey = c_custkey")
def _(s):
    return s.base("orders").join(s.base("customer"), c("o_custkey") == c("c_custkey")).select("o_orderkey", "c_name")


@query("JN2_left_chain", """select l_orderkey, l_linenumber, o_orderstatus, c_name, n_name, r_name, p_brand, s_name from lineitem
 left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
 left join region on n_regionkey = r_regionkey left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey""")
def _(s):
    b = s.base
    return (b("lineitem").join(b("orders"), c("l_orderkey") == c("o_orderkey"), "left").join(b("customer"), c("o_custkey") == c("c_custkey"), "left")
            .join(b("nation"), c("c_nationkey") == c("n_nationkey"), "left").join(b("region"), c("n_regionkey") == c("r_regionkey"), "left")
            .join(b("part"), c("l_partkey") == c("p_partkey"), "left").join(b("supplier"), c("l_suppkey") == c("s_suppkey"), "left")
            .select("l_orderkey", "l_linenumber", "o_orderstatus", "c_name", "n_name", "r_name", "p_brand", "s_name"))


@query("JN3_multi_key", """select a.l_partkey, a.l_suppkey, a.n_open, b.n_done from
 (select l_partkey, l_suppkey, count(*) as n_open from lineitem where l_linestatus = 'O' group by all) a join
 (select l_partkey, l_suppkey, count(*) as n_done from lineitem where l_linestatus = 'F' group by all) b
 on a.l_partkey = b.l_partkey and a.l_suppkey = b.l_suppkey""")
def _(s):
    count = lambda status, name: s.base("lineitem").filter(c("l_linestatus") == status).groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias(name))
    return count("O", "n_open").join(count("F", "n_done"), ["l_partkey", "l_suppkey"])


@query("JN4_full_outer", """select coalesce(a.user_id, b.user_id) as user_id, n_signup, n_error from
 (select user_id, count(*) as n_signup from events where event_type = 'signup' group by 1) a full outer join
 (select user_id, count(*) as n_error from events where event_type = 'error' group by 1) b on a.user_id = b.user_id""")
def _(s):
    count = lambda kind, name: s.base("events").filter(c("event_type") == kind).groupBy("user_id").agg(F.count("*").alias(name))
    return count("signup", "n_signup").join(count("error", "n_error"), "user_id", "full_outer")


@query("JN5_entity_calendar", """select c_custkey, m::date as month from customer,
 generate_series(timestamp '1995-01-01', timestamp '1995-12-01', interval 1 month) as g(m)""", dates="month")
def _(s):
    months = F.sequence(F.lit("1995-01-01").cast("date"), F.lit("1995-12-01").cast("date"), F.expr("interval 1 month"))
    return s.base("customer").select("c_custkey", F.explode(months).alias("month"))


@query("JN6_lateral_unnest", """select id, unnest(generate_series(date_trunc('month', created), date_trunc('month', valid_to), interval 1 month))::date as month
 from t_subscription_history""", dates="month")
def _(s):
    return s["subscription_history"].select("id", F.explode(date_steps(month_start("created"), month_start("valid_to"), "month")).alias("month"))


@query("JN7_interval_calendar", """select h.id, h.valid_from, d::date as obs_date from t_subscription_history h join
 (select unnest(generate_series(timestamp '1996-01-01', timestamp '1997-12-31', interval 1 day)) as d) cal
 on h.valid_from <= d and h.valid_to >= d""", dates="valid_from obs_date")
def _(s):
    spans = s["subscription_history"].select("id", "valid_from", "valid_to")
    return expand_intervals(spans, "valid_from", "valid_to", "obs_date", "1996-01-01", "1997-12-31").drop("valid_to")


@query("JN8_effective_dated", """select c.id, r.rate from t_charge c left join (select region, rate, effective_from as a, coalesce(
 lead(effective_from) over (partition by region order by effective_from) - 1, date '9999-12-31') as b from t_tax_rates) r
 on r.region = c.region and c.created::date between r.a and r.b""", r4="rate")
def _(s):
    return asof_range_join(s["charge"], finance.tax_rate_history(s), {"region": "region"}, "created").select("id", "rate")


@query("JN9_forward_window", """select a.o_orderkey, count(distinct b.o_orderkey) as n_next, coalesce(sum(b.o_totalprice), 0) as amount
 from orders a left join orders b on a.o_custkey = b.o_custkey and b.o_orderdate > a.o_orderdate
 and b.o_orderdate <= a.o_orderdate + interval 90 day group by 1""", r2="amount")
def _(s):
    o = s.base("orders").withColumn("day", F.to_date("o_orderdate"))
    starts = o.select("o_orderkey", "o_custkey", "day")
    return activity_within(starts, o, ["o_custkey"], "day", "day", 90, "o_orderkey", "o_totalprice", "n_next", "amount").drop("o_custkey", "day")


@query("JN10_later_event", """select a.user_id, a.t as signup, b.t as purchase from
 (select user_id, min(ts) as t from events where event_type = 'signup' group by 1) a left join
 (select user_id, min(ts) as t from events where event_type = 'purchase' group by 1) b on a.user_id = b.user_id and b.t > a.t""",
       stamps="signup purchase")
def _(s):
    first = lambda kind, name: s.base("events").filter(c("event_type") == kind).groupBy("user_id").agg(F.min("ts").alias(name))
    later = first("purchase", "purchase").withColumnRenamed("user_id", "u")
    return first("signup", "signup").join(later, (c("user_id") == c("u")) & (c("purchase") > c("signup")), "left").drop("u")


@query("JN11_case_insensitive", """select m.region, d.country, count(*) as n from t_charge m join
 (select distinct country from t_delivery_cost) d on lower(m.region) = lower(d.country) group by 1, 2""")
def _(s):
    d = s["delivery_cost"].select("country").distinct()
    return s["charge"].join(d, F.lower("region") == F.lower("country")).groupBy("region", "country").agg(F.count("*").alias("n"))


@query("JN12_cast_keys", """select f.ad_id, a.ad_set_id, count(*) as n from t_fb_levels f join t_fb_ad a
 on f.ad_id::varchar = a.id::varchar group by 1, 2""")
def _(s):
    ads = s["fb_ad"].select(c("id").cast("string").alias("k"), "ad_set_id")
    return (s["fb_levels"].join(ads, c("ad_id").cast("string") == c("k")).groupBy("ad_id", "ad_set_id").agg(F.count("*").alias("n")))


@query("JN13_coalesced_key", """select o.sys_id, p.product_id from t_app_order o left join t_price p
 on coalesce(o.prescription_price_id, o.price_id) = p.id""")
def _(s):
    price = s["price"].select(c("id").alias("k"), "product_id")
    return s["app_order"].join(price, F.coalesce("prescription_price_id", "price_id") == c("k"), "left").select("sys_id", "product_id")


@query("JN14_computed_key", """select p.p_partkey, g.n from part p join (select case when p_type in ('SMALL', 'MEDIUM') then 'S+M' else p_type end as grp,
 count(*) as n from part group by 1) g on g.grp = case when p.p_type in ('SMALL', 'MEDIUM') then 'S+M' else p.p_type end""")
def _(s):
    part = s.base("part").withColumn("grp", F.when(c("p_type").isin("SMALL", "MEDIUM"), "S+M").otherwise(c("p_type")))
    return part.join(part.groupBy("grp").agg(F.count("*").alias("n")), "grp").select("p_partkey", "n")


@query("JN15_regex_key", """select p.message_id, m.condition from t_page_event p left join t_condition_map m
 on nullif(regexp_extract(p.name, 'Health Profile - ([^-]+) -', 1), '') = m.raw_condition""")
def _(s):
    pages = s["page_event"].withColumn("raw_condition", regex_group("name", "Health Profile - ([^-]+) -"))
    return pages.join(s["condition_map"], "raw_condition", "left").select("message_id", "condition")


@query("JN16_json_key", """select c.id, o.short_id from t_charge c left join t_app_order o
 on json_extract_string(c.metadata, '$.orderId') = o.sys_id""")
def _(s):
    orders = s["app_order"].select("sys_id", "short_id")
    # the key is a column of its own: as an expression of the join it would be read from the JSON anew at every comparison of the sort
    charges = s["charge"].select("id", json_scalar("metadata", "$.orderId").alias("order_id"))
    return charges.join(orders, c("order_id") == c("sys_id"), "left").select("id", "short_id")


@query("JN17_two_roles", """select l.l_orderkey, l.l_linenumber, a.n_name as customer_nation, b.n_name as supplier_nation from lineitem l
 join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey
 join nation a on c_nationkey = a.n_nationkey join nation b on s_nationkey = b.n_nationkey""")
def _(s):
    b = s.base
    role = lambda key, name: b("nation").select(c("n_nationkey").alias(key), c("n_name").alias(name))
    return (b("lineitem").join(b("orders"), c("l_orderkey") == c("o_orderkey")).join(b("customer"), c("o_custkey") == c("c_custkey"))
            .join(b("supplier"), c("l_suppkey") == c("s_suppkey")).join(role("c_nationkey", "customer_nation"), "c_nationkey")
            .join(role("s_nationkey", "supplier_nation"), "s_nationkey")
            .select("l_orderkey", "l_linenumber", "customer_nation", "supplier_nation"))


@query("JN18_group_first", """select o.o_orderkey, case when o.o_orderdate = f.d then 'Yes' else 'No' end as is_first from orders o
 join (select o_custkey, min(o_orderdate) as d from orders group by 1) f on o.o_custkey = f.o_custkey""")
def _(s):
    o = with_group_value(s.base("orders"), ["o_custkey"], first=F.min("o_orderdate"))
    return o.select("o_orderkey", F.when(c("o_orderdate") == c("first"), "Yes").otherwise("No").alias("is_first"))


@query("JN19_anti", "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')")
def _(s):
    returned = s.base("lineitem").filter(c("l_returnflag") == "R")
    return anti_join(s.base("orders"), returned, c("l_orderkey") == c("o_orderkey")).select("o_orderkey")


@query("JN20_exists_flag", """select c_custkey, exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 480000) as big_buyer
 from customer""")
def _(s):
    big = s.base("orders").filter(c("o_totalprice") > 480000).select("o_custkey").distinct()
    return s.base("customer").join(big, c("o_custkey") == c("c_custkey"), "left").select("c_custkey", c("o_custkey").isNotNull().alias("big_buyer"))


@query("JN21_key_spine", """select k.day, coalesce(a.n, 0) as n_views, coalesce(b.n, 0) as n_orders from
 (select ts::date as day from t_page_event union select created_at::date from t_app_order) k
 left join (select ts::date as day, count(*) as n from t_page_event group by 1) a on a.day = k.day
 left join (select created_at::date as day, count(*) as n from t_app_order group by 1) b on b.day = k.day""", dates="day")
def _(s):
    daily = lambda df, col, name: df.groupBy(F.to_date(col).alias("day")).agg(F.count("*").alias(name))
    return merge_metrics(["day"], [daily(s["page_event"], "ts", "n_views"), daily(s["app_order"], "created_at", "n_orders")])


@query("JN22_differing_names", "select p.id, s.product_name from t_price p join t_price_sheet s on s.price_id = p.id")
def _(s):
    return s["price"].join(s["price_sheet"], c("id") == c("price_id")).select("id", "product_name")


@query("JN23_suffixes", """select a.month, a.v as cost_local_export, b.v as cost_local_warehouse from
 (select date_trunc('month', date)::date as month, sum(spent) as v from t_taboola_report group by 1) a left join
 (select date_trunc('month', date)::date as month, sum(amount) as v from t_manual_spend group by 1) b on a.month = b.month""",
       dates="month", r2="cost_local_export cost_local_warehouse")
def _(s):
    a = s["taboola_report"].select("date", c("spent").alias("cost_local"))
    return reconcile(a, s["manual_spend"].select("date", c("amount").alias("cost_local")), "date", "cost_local")


@query("JN24_constant_key", """select o.date, o.email, r.rate from (select date, email from t_cod_sg_new) o left join
 (select rate, effective_from as a, coalesce(lead(effective_from) over (partition by region order by effective_from) - 1, date '9999-12-31') as b
  from t_tax_rates where region = 'sg') r on o.date between r.a and r.b""", dates="date", r4="rate")
def _(s):
    tax = finance.tax_rate_history(s).filter(c("region") == "sg")
    return asof_range_join(s["cod_sg_new"].select("date", "email"), tax, {"region": F.lit("sg")}, "date", by_year=True)

"""Composite operators, each on the test tables or the tables derived from them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions import CHANNEL_PREFIXES, map_channel, month_start
from ..operators.asof import asof_merge
from ..operators.calendar import expand_intervals, zero_fill
from ..operators.dedup import latest_per_key
from ..operators.joins import with_group_value
from ..operators.lifecycle import (churn_rates, lifecycle_summary, ltv_cac, tag_acquisition, tag_lifecycle, tag_status)
from ..operators.margin import kpi_ratios, margin_waterfall, period_change, pivot_txn, split_signed, tax_included
from ..operators.metrics import annual_totals, merge_metrics, reconcile, unmapped, with_baseline
from ..operators.money import to_local, to_usd
from ..operators.proration import prorate
from ..operators.ranges import asof_range_join, effective_ranges
from ..operators.scoring import score_rows
from ..operators.sequence import (activity_within, attribute_history, conversion_share, cross_share, cumulative_by, daily_counts,
                                  detect_increase, first_touch_funnel, sequence_events)
from ..operators.subscriptions import effective_end, monthly_recurring, month_snapshot
from ..operators.sweep import at_month_starts, by_day
from ..operators.variants import flatten_variant
from ..plans import finance, payments
from ..sources.regions import region_union
from ..sources.writers import materialise, number_batches
from .hubs import START, ladder, scalar
from .registry import query
from .rows import by_region

c = F.col
AS_OF = "2001-06-30"


def orders(s):
    return s.base("orders").withColumn("day", F.to_date("o_orderdate"))


@query("CMP1_latest_per_key", """select l_partkey, l_orderkey, l_linenumber, l_shipdate::date as day from lineitem qualify row_number() over (partition by l_partkey
 order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_suppkey desc) = 1""", dates="day")
def _(s):
    newest = latest_per_key(s.base("lineitem"), ["l_partkey"], ["l_shipdate"], tie_break=["l_orderkey", "l_linenumber", "l_suppkey"])
    return newest.select("l_partkey", "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"))


@query("CMP2_region_union", "select region, id, amount, fee from t_balance_transaction")
def _(s):
    return region_union(by_region(s["balance_transaction"]), ["id", "amount", "fee"]).select("region", "id", "amount", "fee")


@query("CMP3_effective_ranges", """select 'closed' as kind, p_partkey, effective_date as from_date, coalesce(lead(effective_date) over w - 1, date '9999-12-31') as to_date from t_marketplace_cogs
 window w as (partition by p_partkey order by effective_date) union all select 'touching', p_partkey, effective_date, coalesce(lead(effective_date) over w, date '9999-12-31')
 from t_marketplace_cogs window w as (partition by p_partkey order by effective_date)""", dates="from_date to_date")
def _(s):
    kind = lambda name, closed: effective_ranges(s["marketplace_cogs"], ["p_partkey"], "effective_date", closed).select(
        F.lit(name).alias("kind"), "p_partkey", "from_date", "to_date")
    return kind("closed", True).unionByName(kind("touching", False))


@query("CMP4_asof_range_join", """select l.l_orderkey, l.l_linenumber, l.l_partkey, k.cogs from lineitem l left join (select p_partkey, cogs, effective_date as a,
 coalesce(lead(effective_date) over (partition by p_partkey order by effective_date) - 1, date '9999-12-31') as b from t_marketplace_cogs) k
 on k.p_partkey = l.l_partkey and l.l_shipdate::date between k.a and k.b""", r4="cogs")
def _(s):
    cost = effective_ranges(s["marketplace_cogs"].select("p_partkey", "cogs", "effective_date"), ["p_partkey"], "effective_date")
    return asof_range_join(s.base("lineitem"), cost, {"p_partkey": "l_partkey"}, "l_shipdate").select("l_orderkey", "l_linenumber", "l_partkey", "cogs")


@query("CMP4_asof_merge", """select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, k.cogs from lineitem l left join (select p_partkey, cogs, effective_date as a,
 coalesce(lead(effective_date) over (partition by p_partkey order by effective_date) - 1, date '9999-12-31') as b from t_marketplace_cogs) k
 on k.p_partkey = l.l_partkey and l.l_shipdate::date between k.a and k.b""", r4="cogs")
def _(s):
    lines = s.base("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return asof_merge(lines, s["marketplace_cogs"], {"p_partkey": "l_partkey"}, "l_shipdate", "effective_date", ["cogs"]).drop("l_shipdate")


@query("JN8_asof_merge", """select c.id, r.refund_id, r.refund_amount from t_charge c asof left join (select region, created, max(id) as refund_id,
 arg_max(amount_refunded, id) as refund_amount from t_charge where amount_refunded > 0 group by 1, 2) r on c.region = r.region and c.created >= r.created""")
def _(s):
    refunds = s["charge"].filter("amount_refunded > 0").select("region", "created", c("id").alias("refund_id"), c("amount_refunded").alias("refund_amount"))
    charges = s["charge"].select("id", "region", "created")
    return asof_merge(charges, refunds, {"region": "region"}, "created", "created", ["refund_id", "refund_amount"], tie_break=["refund_id"]).select(
        "id", "refund_id", "refund_amount")


@query("CMP5_currency", """select c.id, c.amount / f.fx_to_usd / coalesce(u.subunits, 100) as amount_usd, c.amount / f.fx_to_usd / coalesce(u.subunits, 100) * f.fx_to_usd as amount_local
 from t_charge c left join t_fx f on f.currency = c.currency left join t_subunits u on u.currency = c.currency""", r4="amount_usd amount_local")
def _(s):
    usd = to_usd(s["charge"], "amount", "currency", s["fx"], s["subunits"])
    return to_local(usd, "amount_usd", "currency", s["fx"]).select("id", "amount_usd", "amount_local")


@query("CMP6_merge_metrics", """select k.p, k.m, coalesce(a.n_orders, 0) as n_orders, coalesce(b.n_urgent, 0) as n_urgent, d.best from
 (select p_brand as p, 'x' as m from part union select o_orderpriority, o_orderstatus from orders) k
 left join (select o_orderpriority as p, o_orderstatus as m, count(*) as n_orders from orders group by 1, 2) a on a.p = k.p and a.m = k.m
 left join (select o_orderpriority as p, o_orderstatus as m, count(*) as n_urgent from orders where o_totalprice > 400000 group by 1, 2) b on b.p = k.p and b.m = k.m
 left join (select p_brand as p, 'x' as m, max(p_retailprice) as best from part group by 1) d on d.p = k.p and d.m = k.m""", r2="best")
def _(s):
    count = lambda df, name: df.groupBy(c("o_orderpriority").alias("p"), c("o_orderstatus").alias("m")).agg(F.count("*").alias(name))
    best = s.base("part").groupBy(c("p_brand").alias("p"), F.lit("x").alias("m")).agg(F.max("p_retailprice").alias("best"))
    return merge_metrics(["p", "m"], [count(s.base("orders"), "n_orders"), count(s.base("orders").filter("o_totalprice > 400000"), "n_urgent"), best],
                         fill={"n_orders": 0, "n_urgent": 0})


@query("CMP7_zero_fill", """select g.o_custkey, g.month, coalesce(v.total, 0) as total from (select o_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)),
 timestamp '2001-08-01', interval 1 month))::date as month from orders group by 1) g left join (select o_custkey, date_trunc('month', o_orderdate)::date as month, sum(o_totalprice) as total
 from orders group by 1, 2) v on v.o_custkey = g.o_custkey and v.month = g.month""", dates="month", r2="total")
def _(s):
    rows = orders(s).select("o_custkey", c("day").alias("month"), c("o_totalprice").alias("total"))
    return zero_fill(rows, ["o_custkey"], "month", "total", end="2001-08-01")


@query("CMP8_expand_intervals", """select id, valid_from, valid_to, unnest(generate_series(greatest(valid_from, date '1996-01-01')::timestamp, least(valid_to + 1, date '2000-12-31')::timestamp,
 interval 1 day))::date as obs_date from t_subscription_history""", dates="valid_from valid_to obs_date")
def _(s):
    spans = s["subscription_history"].select("id", "valid_from", "valid_to")
    return expand_intervals(spans, "valid_from", "valid_to", "obs_date", "1996-01-01", "2000-12-31", tail_days=1)


@query("CMP8_expand_months", """select id, d::date as obs_date from (select id, valid_from, valid_to, unnest(generate_series(date_trunc('month', valid_from), valid_to::timestamp, interval 1 month)) as d
 from t_subscription_history) x where d >= valid_from and d <= date '2000-12-31'""", dates="obs_date")
def _(s):
    spans = s["subscription_history"].select("id", "valid_from", "valid_to")
    return expand_intervals(spans, "valid_from", "valid_to", "obs_date", "1990-01-01", "2000-12-31", step="month").select("id", "obs_date")


LEVELS = """select region, condition, obs_date as day, count(*) as n_items, count(*) filter (ended_at >= obs_date) as n_live,
 coalesce(sum(round(mrr_usd * 1000000)::bigint), 0)::bigint as mrr_micros from h_metrics"""


@query("CMP8_sweep_days", f"{LEVELS} group by all", dates="day")
def _(s):
    return by_day(payments.subscription_levels(s, AS_OF, START), START, AS_OF)


@query("CMP11_sweep_months", f"{LEVELS} where day(obs_date) = 1 group by all", dates="day")
def _(s):
    return at_month_starts(payments.subscription_levels(s, AS_OF, START), START, AS_OF, out="day")


@query("CMP9_monthly_recurring", """select i.subscription_id, p.id as plan_id, case p.plan_interval when 'month' then v / n when 'year' then v / (12 * n) when 'week' then v * 52 / 12 / n
 when 'day' then v * 365 / 12 / n else 0 end as mrr from (select *, coalesce(interval_count, 1) as n from t_plan) p join (select m.*, 1 as one from t_subscription_item m) i on i.plan_id = p.id
 cross join lateral (select p.amount * i.quantity / 100 as v) x""", r6="mrr")
def _(s):
    plan = s["plan"].select(c("id").alias("plan_id"), "amount", "plan_interval", "interval_count")
    return s["subscription_item"].join(plan, "plan_id").select("subscription_id", "plan_id", monthly_recurring(
        "amount", "quantity", "plan_interval", "interval_count", 100).alias("mrr"))


@query("CMP10_effective_end", """select l.subscription_id, case when l.status = 'canceled' then p.paid else l.ended_at end as ended_at from h_latest l
 join h_paid p on p.subscription_id = l.subscription_id""", dates="ended_at")
def _(s):
    return effective_end(payments.latest_subscriptions(s), s["invoice"], s["charge"]).select("subscription_id", "ended_at")


def daily_totals(s):
    """Customer x day order value, zero on days with only returned-status orders."""
    value = F.when(c("o_orderstatus") == "F", 0.0).otherwise(c("o_totalprice"))
    return orders(s).groupBy("o_custkey", "day").agg(F.sum(value).alias("value"))


DAILY = "select o_custkey, o_orderdate::date as day, sum(case when o_orderstatus = 'F' then 0 else o_totalprice end) as value from orders group by 1, 2"
SNAP = f"""select o_custkey, case when value > 0 or day(day) = 1 then day else (date_trunc('month', day) + interval 1 month)::date end as month, sum(value) as value
 from ({DAILY}) d where value = 0 or day(day) = 1 group by 1, 2"""


@query("CMP11_month_snapshot", SNAP, dates="month", r2="value")
def _(s):
    return month_snapshot(daily_totals(s), ["o_custkey"], "day", "value").withColumnRenamed("day", "month")


MONTHLY = "select o_custkey, date_trunc('month', o_orderdate)::date as month, sum(case when o_orderstatus = 'F' then 0 else o_totalprice end) as value from orders group by 1, 2"
TAGGED = f"""select *, case when month = first_month then 'New' when value = 0 and lagged > 0 then 'Churn' when value > 0 and coalesce(lagged, 0) = 0 then 'Reactivation'
 when value > lagged then 'Expansion' when value < lagged then 'Contraction' when value = lagged then 'Retention' end as lifecycle from (select *,
 lag(value) over (partition by o_custkey order by month) as lagged, min(month) over (partition by o_custkey) as first_month from ({MONTHLY}) m) l"""


def tagged(s):
    value = F.when(c("o_orderstatus") == "F", 0.0).otherwise(c("o_totalprice"))
    monthly = orders(s).groupBy("o_custkey", month_start("day").alias("month")).agg(F.sum(value).alias("value"))
    return tag_lifecycle(monthly, ["o_custkey"], "month", "value")


@query("CMP12_tag_lifecycle", f"select o_custkey, month, value, lagged, lifecycle from ({TAGGED}) t", dates="month", r2="value lagged")
def _(s):
    return tagged(s).select("o_custkey", "month", "value", "lagged", "lifecycle")


SUMMARY = f"select month, lifecycle, count(distinct o_custkey) as n, sum(value) as current_mrr, sum(lagged) as lagged_mrr from ({TAGGED}) t group by 1, 2"


@query("CMP13_lifecycle_summary", SUMMARY, dates="month", r2="current_mrr lagged_mrr")
def _(s):
    return lifecycle_summary(tagged(s), ["month", "lifecycle"], "o_custkey", "value", "n")


@query("CMP14_churn_rates", f"""select a.month, a.n as n_churned, a.d as mrr_delta, b.n, b.v as mrr_usd, a.n / lag(b.n) over (order by a.month) as churn_rate,
 -a.d / lag(b.v) over (order by a.month) as dollar_churn_rate from (select month, count(distinct o_custkey) as n, sum(value - lagged) as d from ({TAGGED}) t where value = 0 and lagged > 0 and
 month <> first_month group by 1) a join (select month, count(*) as n, sum(value) as v from ({TAGGED}) t where value > 0 group by 1) b on b.month = a.month""",
       dates="month", r2="mrr_delta mrr_usd", r6="churn_rate dollar_churn_rate")
def _(s):
    value = F.when(c("o_orderstatus") == "F", 0.0).otherwise(c("o_totalprice"))
    monthly = orders(s).groupBy("o_custkey", month_start("day").alias("month")).agg(F.sum(value).alias("mrr_usd"))
    dated = with_group_value(monthly, ["o_custkey"], created=F.min("month"))
    status = tag_status(dated, "o_custkey", "month", "mrr_usd", "created")
    summary = status.groupBy("month", "status").agg(F.countDistinct("o_custkey").alias("n"), F.sum("mrr_delta").alias("mrr_delta"))
    actives = status.filter("mrr_usd > 0").groupBy("month").agg(F.count("*").alias("n"), F.sum("mrr_usd").alias("mrr_usd"))
    return churn_rates(summary, actives, "month")


@query("CMP15_ltv_cac", f"""with life as ({SUMMARY}) select a.*, x.n_churned_customers, x.churned_mrr, lag(a.current_n_customers) over (order by a.month) as base_n_customers,
 lag(a.current_mrr) over (order by a.month) as base_mrr, g.net from (select 'all' as seg, month, sum(if(lifecycle = 'New', n, 0))::bigint as n_new_customers, sum(current_mrr) as current_mrr,
 sum(n)::bigint as current_n_customers from life where current_mrr > 0 group by 2) a left join (select month, sum(n)::bigint as n_churned_customers, sum(lagged_mrr) as churned_mrr from life
 where lifecycle = 'Churn' group by 1) x on x.month = a.month left join (select date_trunc('month', l_shipdate)::date as month, sum(l_extendedprice * (1 - l_discount)) as net from lineitem group by 1) g
 on g.month = a.month""", dates="month", r2="current_mrr churned_mrr base_mrr", r4="net")
def _(s):
    life = lifecycle_summary(tagged(s).withColumn("seg", F.lit("all")), ["seg", "month", "lifecycle"], "o_custkey", "value", "n")
    margin = s.base("lineitem").groupBy(F.lit("all").alias("seg"), month_start("l_shipdate").alias("month")).agg(
        F.sum(c("l_extendedprice") * (1 - c("l_discount"))).alias("net"))
    return ltv_cac(life, margin, ["seg"], "month", "n", "customers")


@query("CMP16_prorate", """select l_orderkey, l_linenumber, l_partkey, l_extendedprice / sum(l_extendedprice) over (partition by l_orderkey) * o_totalprice as part_of_order
 from lineitem join orders on o_orderkey = l_orderkey""", r2="part_of_order")
def _(s):
    pool = s.base("orders").select(c("o_orderkey").alias("l_orderkey"), "o_totalprice")
    return prorate(s.base("lineitem").join(pool, "l_orderkey"), "l_extendedprice", "o_totalprice", ["l_orderkey"], "part_of_order").select(
        "l_orderkey", "l_linenumber", "l_partkey", "part_of_order")


@query("CMP17_tax_included", "select l_orderkey, l_linenumber, l_partkey, l_extendedprice * l_tax / (1 + l_tax) as tax from lineitem", r4="tax")
def _(s):
    return s.base("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", tax_included(c("l_extendedprice"), "l_tax").alias("tax"))


@query("CMP18_margin_waterfall", """select l_partkey, amount as gross_revenue, amount - refunds - tax_paid_usd as net_revenue, amount - refunds - cogs as gross_profit,
 amount - refunds - cogs - packaging - delivery_cost - gateway_fees as cm2, amount - refunds - cogs - packaging - delivery_cost - gateway_fees - marketing_cost as cm3,
 amount - refunds - cogs - packaging - delivery_cost - gateway_fees - marketing_cost - operating_expense - staff_cost as ebitda from (select l_partkey, sum(l_extendedprice) as amount,
 sum(if(l_returnflag = 'R', l_extendedprice, 0)) as refunds, sum(l_extendedprice * l_tax) as tax_paid_usd, sum(l_quantity * 300) as cogs, sum(l_quantity) as packaging,
 sum(l_quantity * 0.5) as delivery_cost, sum(l_extendedprice * 0.03) as gateway_fees, sum(l_extendedprice * l_discount) as marketing_cost, sum(l_quantity * 2) as operating_expense,
 sum(l_quantity * 3) as staff_cost from lineitem group by 1) x""", r4="gross_revenue net_revenue gross_profit cm2 cm3 ebitda")
def _(s):
    price, qty = c("l_extendedprice"), c("l_quantity")
    sums = {"amount": price, "refunds": F.when(c("l_returnflag") == "R", price).otherwise(0.0), "tax_paid_usd": price * c("l_tax"), "cogs": qty * 300,
            "packaging": F.when(qty > 0, qty), "delivery_cost": qty * 0.5, "gateway_fees": price * 0.03, "marketing_cost": price * c("l_discount"),
            "operating_expense": qty * 2, "staff_cost": qty * 3}
    parts = s.base("lineitem").groupBy("l_partkey").agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    return margin_waterfall(parts).select("l_partkey", "gross_revenue", "net_revenue", "gross_profit", "cm2", "cm3", "ebitda")


@query("CMP19_acquisition", """select o_orderkey, d as acquisition_date, case when o_orderdate <= d + interval 7 day then 'New' when d is not null then 'Existing' end as new_existing
 from (select *, min(o_orderdate::date) over (partition by o_custkey) as d from orders) x""", dates="acquisition_date")
def _(s):
    return tag_acquisition(orders(s), "o_custkey", "day").select("o_orderkey", "acquisition_date", "new_existing")


@query("CMP20_cumulative", """select o_custkey, month, rev, min(month) over (partition by o_custkey) as acq_date, sum(rev) over (partition by o_custkey order by month) as cum_rev from (select o_custkey,
 date_trunc('month', o_orderdate)::date as month, sum(o_totalprice) as rev from orders group by 1, 2) m""", dates="month acq_date", r2="rev cum_rev")
def _(s):
    rows = orders(s).select("o_custkey", month_start("day").alias("month"), c("o_totalprice").alias("rev"))
    return cumulative_by(rows, "o_custkey", "month", "rev", out="cum_rev")


@query("CMP21_sequence", """select o_orderkey, row_number() over w as event_number, lead(o_orderdate::date) over w as next_date from orders
 window w as (partition by o_custkey order by o_orderdate, o_orderkey)""", dates="next_date")
def _(s):
    return sequence_events(orders(s), "o_custkey", "day", ["o_orderkey"]).select("o_orderkey", "event_number", "next_date")


@query("CMP22_first_touch", """select a.user_id, a.event_id, a.ts as start_time, b.t as reached_time from (select * from events where event_type = 'signup'
 qualify row_number() over (partition by user_id order by ts, event_id) = 1) a left join (select user_id, min(ts) as t from events where event_type = 'purchase' group by 1) b
 on b.user_id = a.user_id""", stamps="start_time reached_time")
def _(s):
    return first_touch_funnel(s.base("events"), "user_id", "event_type", "ts", "event_id", "signup", "purchase")


@query("CMP23_activity_within", """select a.o_custkey, a.d as start, count(distinct o.o_orderkey) as n_90d, coalesce(sum(o.o_totalprice), 0) as amount_90d from
 (select o_custkey, min(o_orderdate::date) as d from orders group by 1) a left join orders o on o.o_custkey = a.o_custkey and o.o_orderdate > a.d and o.o_orderdate <= a.d + interval 90 day
 group by 1, 2""", dates="start", r2="amount_90d")
def _(s):
    starts = orders(s).groupBy("o_custkey").agg(F.min("day").alias("start"))
    return activity_within(starts, orders(s), ["o_custkey"], "start", "day", 90, "o_orderkey", "o_totalprice", "n_90d", "amount_90d")


@query("CMP24_conversion_share", """select converted, n_customers, n_customers / sum(n_customers) over () as share from (select b.d is not null as converted, count(distinct a.o_custkey) as n_customers from
 (select o_custkey, min(o_orderdate) as d from orders where o_orderpriority = '5-LOW' group by 1) a left join (select o_custkey, min(o_orderdate) as d from orders where o_orderpriority = '1-URGENT' group by 1) b
 on b.o_custkey = a.o_custkey and b.d > a.d group by 1) x""", r6="share")
def _(s):
    first = lambda p: orders(s).filter(c("o_orderpriority") == p).groupBy("o_custkey").agg(F.min("day").alias("d"))
    return conversion_share(first("5-LOW"), first("1-URGENT"), "o_custkey", "d")


@query("CMP25_cross_share", """select c_mktsegment, has_promo, n_customers, round(n_customers / sum(n_customers) over (partition by c_mktsegment), 2) as share_of_group from (
 select c_mktsegment, c_custkey in (select o_custkey from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey where p_type = 'PROMO') as has_promo,
 count(*) as n_customers from customer group by 1, 2) x""", r2="share_of_group")
def _(s):
    promo = (s.base("orders").join(s.base("lineitem"), c("l_orderkey") == c("o_orderkey"))
             .join(s.base("part").filter(c("p_type") == "PROMO"), c("p_partkey") == c("l_partkey")).select(c("o_custkey").alias("c_custkey")))
    return cross_share(s.base("customer"), promo, "c_custkey", ["c_mktsegment"], "has_promo")


@query("CMP26_detect_increase", """with h as (select *, lag(l_quantity) over w as prev, first_value(l_quantity) over w as first_qty from (select distinct l_partkey, l_suppkey, l_quantity,
 l_shipdate::date as day, f.d as created from lineitem join (select l_partkey as p, min(l_shipdate::date) as d from lineitem group by 1) f on f.p = l_partkey) x
 window w as (partition by l_partkey, l_suppkey order by day, l_quantity)) select a.l_partkey, a.l_suppkey, a.created, b.day, a.first_qty as first_l_quantity, b.l_quantity as current_l_quantity,
 date_diff('day', b.created, b.day) as days_elapsed from (select * from h where first_qty <= 30 and l_quantity > 0 qualify row_number() over (partition by l_partkey, l_suppkey order by day, l_quantity) = 1) a
 left join h b on b.l_partkey = a.l_partkey and b.l_suppkey = a.l_suppkey and b.l_quantity > b.prev and b.l_quantity > 30 and date_diff('day', b.created, b.day) <= 900""",
       dates="created day", r2="first_l_quantity current_l_quantity", ints="days_elapsed")
def _(s):
    first = s.base("lineitem").groupBy(c("l_partkey").alias("p")).agg(F.to_date(F.min("l_shipdate")).alias("created"))
    rows = (s.base("lineitem").join(first, c("p") == c("l_partkey"))
            .select("l_partkey", "l_suppkey", "l_quantity", F.to_date("l_shipdate").alias("day"), "created").distinct())
    keys = ["l_partkey", "l_suppkey"]
    history = attribute_history(rows, keys, ["day", "l_quantity"], "l_quantity")
    rises = detect_increase(history, keys, "l_quantity", "day", "created", 30, 900, c("l_quantity") > 0)
    return rises.withColumn("days_elapsed", c("days_elapsed").cast("long"))


@query("CMP27_map_channel", f"select message_id, {ladder('context_campaign_source', CHANNEL_PREFIXES, lower=True)} as channel from t_page_event")
def _(s):
    return s["page_event"].select("message_id", map_channel("context_campaign_source", CHANNEL_PREFIXES, ignore_case=True).alias("channel"))


@query("CMP28_flatten_json", f"""select sys_id, coalesce({scalar('j', '$.total')}, {scalar('j', '$[0].total')})::bigint as total,
 coalesce({scalar('j', '$.subTotal')}, {scalar('j', '$[0].subTotal')})::bigint as sub_total, coalesce({scalar('j', '$.isConsult')}, {scalar('j', '$[0].isConsult')})::boolean as is_consult,
 coalesce({scalar('j', '$.consultFee')}, {scalar('j', '$[0].consultFee')})::bigint as fee from (select sys_id, prescription_order_calculation as j from t_app_order) x""")
def _(s):
    fields = {"total": "bigint", "sub_total": ("subTotal", "bigint"), "is_consult": ("isConsult", "boolean"), "fee": ("consultFee", "bigint")}
    return flatten_variant(s["app_order"], "prescription_order_calculation", fields, strict=True).select("sys_id", *fields)


CHANNEL_LINES = ["sales_channel", "region", "purchase_type", "customer_id", "charge_id", "purchase_date", "product_id", "product_name", "condition", "quantity",
                 "currency", "line_item_amount_usd", "amount_refunded_usd", "cogs", "packaging", "fee_rate", "acquisition_date"]


@query("CMP29_normalize_sales", f"select {', '.join(CHANNEL_LINES)} from h_lines", dates="purchase_date acquisition_date", ints="quantity",
       r4="line_item_amount_usd amount_refunded_usd cogs packaging", r6="fee_rate")
def _(s):
    boxes = finance.product_cost_per_box(s["product_cost"])
    market, cost, tax = finance.marketplace_costs(s), finance.product_cost(s, boxes), finance.tax_rate_history(s)
    # channels of large tables are staged one by one, so that the shuffle files of one at a time are on disk
    large = finance.line_slices(s) > 1
    part = lambda df: materialise(df.select(*CHANNEL_LINES)) if large else df.select(*CHANNEL_LINES)
    rows = finance.normalize_sales([
        finance.stripe_sales(s, cost, columns=CHANNEL_LINES), part(finance.tiktok_sales(s, market["tiktok"])), part(finance.lazada_sales(s, market["lazada"])),
        part(finance.shopee_sales(s, market["shopee"])), part(finance.cod_sales(s, boxes, finance.cod_sg_orders(s), "sg")),
        part(finance.cod_sales(s, boxes, finance.cod_hk_orders(s), "hk")), part(finance.atome_sales(s, tax, cost))])
    return rows.select(*CHANNEL_LINES)


@query("CMP30_split_signed", """select atome_order_id, sum(greatest(transaction_amount, 0)) as sale_amount, sum(-least(transaction_amount, 0)) as refund_amount,
 sum(-least(transaction_amount, 0)) / sum(greatest(transaction_amount, 0)) as refund_rate from t_atome_manual group by 1 having sum(greatest(transaction_amount, 0)) > 0""",
       r2="sale_amount refund_amount", r6="refund_rate")
def _(s):
    return split_signed(s["atome_manual"], "transaction_amount", ["atome_order_id"])


@query("CMP31_pivot_txn", """select transaction_date, seller_sku, coalesce(sum(amount) filter (where transaction_type = 'Orders-Sales'), 0) as sales,
 coalesce(sum(-amount) filter (where transaction_type like 'Refunds%'), 0) as refunds, coalesce(sum(-amount) filter (where transaction_type in ('Orders-Lazada Fees', 'Orders-Logistics',
 'Orders-Marketing Fees')), 0) as fees from t_lazada_orders group by 1, 2""", dates="transaction_date", r2="sales refunds fees")
def _(s):
    kind = c("transaction_type")
    return pivot_txn(s["lazada_orders"], ["transaction_date", "seller_sku"], c("amount"), {
        "sales": (kind == "Orders-Sales", 1), "refunds": (kind.startswith("Refunds"), -1), "fees": (kind.isin(finance.LAZADA_FEES), -1)})


RECON = """select a.month, a.v as cost_export, b.v as cost_warehouse from (select date_trunc('month', l_shipdate)::date as month, sum(l_extendedprice) as v from lineitem where l_returnflag <> 'N' group by 1) a
 left join (select date_trunc('month', l_shipdate)::date as month, sum(l_extendedprice) as v from lineitem group by 1) b on b.month = a.month"""


@query("CMP32_reconcile", RECON, dates="month", r2="cost_export cost_warehouse")
def _(s):
    rows = s.base("lineitem").select("l_returnflag", "l_shipdate", c("l_extendedprice").alias("cost"))
    return reconcile(rows.filter(c("l_returnflag") != "N"), rows, "l_shipdate", "cost")


@query("CMP32_annual_totals", f"select year(month) as year, sum(cost_export) as cost_export from ({RECON}) r group by 1", r2="cost_export")
def _(s):
    rows = s.base("lineitem").select("l_returnflag", "l_shipdate", c("l_extendedprice").alias("cost"))
    monthly = reconcile(rows.filter(c("l_returnflag") != "N"), rows, "l_shipdate", "cost")
    return annual_totals(monthly, "month", "cost_export").withColumn("year", c("year").cast("long"))


@query("CMP33_unmapped", """select distinct l_partkey from lineitem where not exists (select 1 from lineitem k where k.l_partkey = lineitem.l_partkey and k.l_quantity >= 47)""")
def _(s):
    return unmapped(s.base("lineitem"), s.base("lineitem").filter("l_quantity >= 47"), ["l_partkey"])


@query("CMP34_export_batches", "select o_orderkey, row_number() over (order by o_custkey, o_orderkey) - 1 as row_index, floor((row_number() over (order by o_custkey, o_orderkey) - 1) / 3000)::bigint + 1 as batch from orders")
def _(s):
    return number_batches(s.base("orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], 3000).drop("o_custkey")


RATIOS = "select r, date_trunc('month', o_orderdate)::date as date, sum(o_totalprice) as gross_revenue, count(*) as n_orders from (select *, o_orderpriority as r from orders) o group by 1, 2"


@query("CMP35_kpi_ratios", f"""with k as (select *, gross_revenue / n_orders as aov from ({RATIOS}) x) select k.*, (k.gross_revenue - a.gross_revenue) / a.gross_revenue as mom,
 (k.gross_revenue - b.gross_revenue) / b.gross_revenue as yoy from k left join k a on a.r = k.r and a.date = k.date - interval 1 month left join k b on b.r = k.r and b.date = k.date - interval 12 month""",
       dates="date", r2="gross_revenue", r4="aov", r6="mom yoy")
def _(s):
    monthly = orders(s).groupBy(c("o_orderpriority").alias("r"), month_start("day").alias("date")).agg(F.sum("o_totalprice").alias("gross_revenue"), F.count("*").alias("n_orders"))
    out = period_change(kpi_ratios(monthly), "date", "gross_revenue", ["r"], 1, "mom")
    return period_change(out, "date", "gross_revenue", ["r"], 12, "yoy")


@query("CMP36_with_baseline", """select 'main' as metric_type, o_orderkey, o_totalprice as v from orders union all select 'baseline', o_orderkey, -o_totalprice from orders""", r2="v")
def _(s):
    return with_baseline(s.base("orders").select("o_orderkey", c("o_totalprice").alias("v")), "v")


@query("CMP37_daily_funnel", """select coalesce(a.date, b.date) as date, coalesce(a.props, b.props) as props, n_created, n_scheduled from (select ts::date as date, props, count(distinct user_id) as n_created
 from events where event_type = 'signup' group by 1, 2) a full join (select ts::date as date, props, count(distinct user_id) as n_scheduled from events where event_type = 'purchase' group by 1, 2) b
 on b.date = a.date and b.props = a.props""", dates="date")
def _(s):
    counts = lambda kind, name: daily_counts(s.base("events").filter(c("event_type") == kind), F.to_date("ts"), ["props"], "user_id", name)
    return counts("signup", "n_created").join(counts("purchase", "n_scheduled"), ["date", "props"], "full_outer")


def letter_share(batch):
    letters = batch["text"].map(lambda t: sum(map(str.isalpha, t)) / len(t))
    return letters.to_frame("letters")


@query("UDF1_score_rows", r"""select doc_id, length(regexp_replace(text, '[^\p{L}]', '', 'g')) / length(text) as letters, null::varchar as error
 from documents""", r6="letters")
def _(s):
    return score_rows(s.base("documents"), "doc_id", ["text"], "text", letter_share, StructType([StructField("letters", DoubleType())]), unique=True).drop("text")

"""Window functions."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import month_start
from ..operators.dedup import latest_per_key
from ..operators.joins import with_group_value
from ..operators.proration import add_share
from ..operators.ranges import effective_ranges
from ..operators.sequence import cumulative_by, sequence_events, share_of_groups, with_neighbours
from .registry import query

c = F.col


def orders(s):
    return s.base("orders").withColumn("day", F.to_date("o_orderdate"))


@query("WIN1_latest_row", """select s.o_custkey, s.o_orderkey, s.o_orderstatus from (select *, row_number() over (partition by o_custkey
 order by o_orderdate desc, o_orderkey desc) as rn from orders) s where rn = 1""")
def _(s):
    return latest_per_key(s.base("orders"), ["o_custkey"], ["o_orderdate"], tie_break=["o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("WIN2_row_number", "select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as purchase_number from orders")
def _(s):
    return sequence_events(orders(s), "o_custkey", "day", ["o_orderkey"], "purchase_number", "n").select("o_custkey", "o_orderkey", "purchase_number")


@query("WIN3_lag", "select o_orderkey, lag(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey) as before from orders", r2="before")
def _(s):
    return with_neighbours(orders(s), ["o_custkey"], ["day", "o_orderkey"], previous={"before": "o_totalprice"}).select("o_orderkey", "before")


@query("WIN4_lag_default", """select l_suppkey, l_returnflag, l_linestatus, m, total, coalesce(lag(total) over (partition by l_suppkey, l_returnflag,
 l_linestatus order by m), 0) as lagged from (select l_suppkey, l_returnflag, l_linestatus, date_trunc('month', l_shipdate)::date as m,
 sum(l_quantity) as total from lineitem group by all) x""", dates="m", r2="total lagged")
def _(s):
    keys = ["l_suppkey", "l_returnflag", "l_linestatus"]
    monthly = s.base("lineitem").groupBy(*keys, month_start(F.to_date("l_shipdate")).alias("m")).agg(F.sum("l_quantity").alias("total"))
    return monthly.withColumn("lagged", F.coalesce(F.lag("total").over(W.partitionBy(*keys).orderBy("m")), F.lit(0.0)))


@query("WIN5_lead", "select o_orderkey, lead(o_orderdate::date) over (partition by o_custkey order by o_orderdate, o_orderkey) as next_date from orders", dates="next_date")
def _(s):
    return with_neighbours(orders(s), ["o_custkey"], ["day", "o_orderkey"], following={"next_date": "day"}).select("o_orderkey", "next_date")


@query("WIN6_validity_end", """select region, id, effective_date as from_date, coalesce(lead(effective_date) over (partition by region, id
 order by effective_date) - 1, date '9999-12-31') as to_date from t_product_cost""", dates="from_date to_date")
def _(s):
    return effective_ranges(s["product_cost"], ["region", "id"], "effective_date").select("region", "id", "from_date", "to_date")


@query("WIN7_window_over_aggregate", """select r, m, n, lag(n) over (partition by r order by m) as lagged_n, lead(n) over (partition by r order by m) as leading_n
 from (select o_orderpriority as r, date_trunc('month', o_orderdate)::date as m, count(distinct o_custkey) as n from orders group by 1, 2) x""", dates="m")
def _(s):
    monthly = orders(s).groupBy(c("o_orderpriority").alias("r"), month_start("day").alias("m")).agg(F.countDistinct("o_custkey").alias("n"))
    w = W.partitionBy("r").orderBy("m")
    return monthly.withColumn("lagged_n", F.lag("n").over(w)).withColumn("leading_n", F.lead("n").over(w))


@query("WIN8_nested_min", """select o_custkey, date_trunc('month', o_orderdate)::date as m, min(min(date_trunc('month', o_orderdate)::date))
 over (partition by o_custkey) as cohort, sum(o_totalprice) as rev from orders group by 1, 2""", dates="m cohort", r2="rev")
def _(s):
    monthly = orders(s).groupBy("o_custkey", month_start("day").alias("m")).agg(F.sum("o_totalprice").alias("rev"))
    return with_group_value(monthly, ["o_custkey"], cohort=F.min("m"))


@query("WIN9_partition_min", "select o_orderkey, min(o_orderdate::date) over (partition by o_custkey) as acq_date from orders", dates="acq_date")
def _(s):
    return with_group_value(orders(s), ["o_custkey"], acq_date=F.min("day")).select("o_orderkey", "acq_date")


@query("WIN10_running_total", """select o_custkey, day, v, sum(v) over (partition by o_custkey order by day) as running from
 (select o_custkey, o_orderdate::date as day, sum(o_totalprice) as v from orders group by 1, 2) x""", dates="day", r2="v running")
def _(s):
    return cumulative_by(orders(s).select("o_custkey", "day", c("o_totalprice").alias("v")), "o_custkey", "day", "v", out="running").drop("acq_date")


@query("WIN11_partition_total", """select l_orderkey, l_linenumber, l_partkey, l_extendedprice / sum(l_extendedprice) over (partition by l_orderkey) as share
 from lineitem""", r6="share")
def _(s):
    return add_share(s.base("lineitem"), "l_extendedprice", ["l_orderkey"], "share").select("l_orderkey", "l_linenumber", "l_partkey", "share")


@query("WIN12_share_of_total", """select c_mktsegment, n, n / sum(n) over () as share from (select c_mktsegment, count(*) as n from customer group by 1) x""", r6="share")
def _(s):
    return share_of_groups(s.base("customer").groupBy("c_mktsegment").agg(F.count("*").alias("n")), "n")


@query("WIN13_first_value", """select o_orderkey, first_value(o_orderpriority) over (partition by o_custkey order by o_orderdate, o_orderkey) as first_priority
 from orders""")
def _(s):
    return with_group_value(s.base("orders"), ["o_custkey"], f=F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey"))).select(
        "o_orderkey", c("f").alias("first_priority"))


@query("WIN14_grouped_delta", """select o_custkey, m, rev - coalesce(lag(rev) over (partition by o_custkey order by m), 0) as delta from
 (select o_custkey, date_trunc('month', o_orderdate)::date as m, sum(o_totalprice) as rev from orders group by 1, 2) x""", dates="m", r2="delta")
def _(s):
    monthly = orders(s).groupBy("o_custkey", month_start("day").alias("m")).agg(F.sum("o_totalprice").alias("rev"))
    before = F.lag("rev").over(W.partitionBy("o_custkey").orderBy("m"))
    return monthly.select("o_custkey", "m", (c("rev") - F.coalesce(before, F.lit(0.0))).alias("delta"))

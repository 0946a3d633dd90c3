"""Aggregations, set operations and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import month_start, safe_divide
from ..operators.dedup import latest_per_key
from ..operators.json_fields import map_of_entries
from ..operators.metrics import with_baseline
from .registry import query

c = F.col


@query("AGG1_group_by", "select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2")
def _(s):
    return s.base("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("AGG2_sum_expression", "select l_suppkey, sum(l_extendedprice * (1 - l_discount)) as revenue from lineitem group by 1", r4="revenue")
def _(s):
    return s.base("lineitem").groupBy("l_suppkey").agg(F.sum(c("l_extendedprice") * (1 - c("l_discount"))).alias("revenue"))


@query("AGG3_count_distinct", "select o_orderpriority, count(o_orderkey) as n, count(distinct o_custkey) as n_customers from orders group by 1")
def _(s):
    return s.base("orders").groupBy("o_orderpriority").agg(F.count("o_orderkey").alias("n"), F.countDistinct("o_custkey").alias("n_customers"))


@query("AGG4_several_distinct", "select l_suppkey, count(distinct l_partkey) as n_parts, count(distinct l_orderkey) as n_orders from lineitem group by 1")
def _(s):
    return s.base("lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n_parts"), F.countDistinct("l_orderkey").alias("n_orders"))


@query("AGG5_conditional_sum", "select l_suppkey, sum(case when l_returnflag = 'R' then l_quantity else 0 end) as returned from lineitem group by 1", r2="returned")
def _(s):
    return s.base("lineitem").groupBy("l_suppkey").agg(F.sum(F.when(c("l_returnflag") == "R", c("l_quantity")).otherwise(0)).alias("returned"))


@query("AGG6_conditional_distinct", "select user_id, count(distinct case when event_type = 'purchase' then props end) as n from events group by 1")
def _(s):
    return s.base("events").groupBy("user_id").agg(F.countDistinct(F.when(c("event_type") == "purchase", c("props"))).alias("n"))


@query("AGG7_min_max", "select o_custkey, min(o_orderdate) as first_order, max(o_orderdate) as last_order from orders group by 1", stamps="first_order last_order")
def _(s):
    return s.base("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))


@query("AGG8_ratio", "select o_custkey, sum(o_totalprice) / count(distinct o_orderdate) as per_day from orders group by 1", r6="per_day")
def _(s):
    return s.base("orders").groupBy("o_custkey").agg(safe_divide(F.sum("o_totalprice"), F.countDistinct("o_orderdate")).alias("per_day"))


@query("AGG9_rounding", "select o_custkey, sum(round(o_totalprice, 0)) as a, round(sum(o_totalprice), 0) as b from orders group by 1", r0="a b")
def _(s):
    return s.base("orders").groupBy("o_custkey").agg(F.sum(F.round("o_totalprice", 0)).alias("a"), F.round(F.sum("o_totalprice"), 0).alias("b"))


@query("AGG10_distinct", "select distinct p_brand, p_type from part")
def _(s):
    return s.base("part").select("p_brand", "p_type").distinct()


@query("AGG11_group_without_aggregate", "select o_custkey, o_orderstatus from orders group by 1, 2")
def _(s):
    return s.base("orders").dropDuplicates(["o_custkey", "o_orderstatus"]).select("o_custkey", "o_orderstatus")


@query("AGG12_distinct_over_aggregate", "select distinct n from (select o_custkey, count(*) as n from orders group by 1) x")
def _(s):
    return s.base("orders").groupBy("o_custkey").agg(F.count("*").alias("n")).select("n").distinct()


@query("AGG13_map_collect", """select price_id, string_agg(key || '=' || value, ',' order by key) as pairs from t_price_metadata group by 1""")
def _(s):
    maps = map_of_entries(s["price_metadata"], ["price_id"], "key", "value", "m")
    return maps.select("price_id", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("pairs"))


@query("AGG14_pivot_coalesce", """select payment_intent_id, coalesce(max(case when key = 'paymentIntentPriceId' then value end),
 max(case when key = 'stripePriceIds' then value end)) as price_id from t_intent_metadata group by 1""")
def _(s):
    pivoted = s["intent_metadata"].groupBy("payment_intent_id").pivot("key", ["paymentIntentPriceId", "stripePriceIds"]).agg(F.max("value"))
    return pivoted.select("payment_intent_id", F.coalesce("paymentIntentPriceId", "stripePriceIds").alias("price_id"))


@query("AGG15_two_level", """select m, avg(n) as per_customer from (select date_trunc('month', o_orderdate)::date as m, o_custkey, count(*) as n
 from orders group by 1, 2) x group by 1""", dates="m", r6="per_customer")
def _(s):
    inner = s.base("orders").groupBy(month_start(F.to_date("o_orderdate")).alias("m"), "o_custkey").agg(F.count("*").alias("n"))
    return inner.groupBy("m").agg(F.avg("n").alias("per_customer"))


@query("AGG16_group_by_case", "select case when o_totalprice > 250000 then 'high' else 'low' end as band, count(*) as n from orders group by 1")
def _(s):
    return s.base("orders").groupBy(F.when(c("o_totalprice") > 250000, "high").otherwise("low").alias("band")).agg(F.count("*").alias("n"))


@query("AGG17_summarise_across", """select user_id, count(*) as n, count(distinct event_type) as kinds, min(value) as lowest, sum(value) as total
 from events group by 1""", r2="lowest total")
def _(s):
    return s.base("events").groupBy("user_id").agg(F.count("*").alias("n"), F.countDistinct("event_type").alias("kinds"),
                                                   F.min("value").alias("lowest"), F.sum("value").alias("total"))


@query("AGG18_distinct_subset", "select distinct source, lang from documents")
def _(s):
    return s.base("documents").select("source", "lang").distinct()


# --- sorts ------------------------------------------------------------------------------------------------------------
@query("SRT1_order_by", "select o_orderkey, o_custkey from orders order by o_custkey, o_orderkey")
def _(s):
    return s.base("orders").select("o_orderkey", "o_custkey").orderBy("o_custkey", "o_orderkey")


@query("SRT2_mixed_order", "select p_type, p_size, count(*) as n from part group by 1, 2 order by 1, 2 desc")
def _(s):
    return s.base("part").groupBy("p_type", "p_size").agg(F.count("*").alias("n")).orderBy("p_type", c("p_size").desc())


@query("SRT3_inner_order", "select p_brand, count(*) as n from (select * from part order by p_name) x group by 1")
def _(s):
    return s.base("part").orderBy("p_name").groupBy("p_brand").agg(F.count("*").alias("n"))


@query("SRT4_arrange", "select c_custkey, c_mktsegment from customer order by c_mktsegment, c_custkey")
def _(s):
    return s.base("customer").select("c_custkey", "c_mktsegment").orderBy("c_mktsegment", "c_custkey")


@query("SRT5_top_per_group", """select l_suppkey, l_partkey, l_extendedprice from lineitem qualify row_number() over
 (partition by l_suppkey order by l_extendedprice desc, l_partkey desc, l_orderkey desc, l_linenumber desc) = 1""", r2="l_extendedprice")
def _(s):
    top = latest_per_key(s.base("lineitem"), ["l_suppkey"], ["l_extendedprice"], tie_break=["l_partkey", "l_orderkey", "l_linenumber"])
    return top.select("l_suppkey", "l_partkey", "l_extendedprice")


# --- set operations -----------------------------------------------------------------------------------------------------
@query("SET1_union_all", """select 'customer' as kind, c_nationkey as nation from customer union all select 'supplier', s_nationkey from supplier""")
def _(s):
    a = s.base("customer").select(F.lit("customer").alias("kind"), c("c_nationkey").alias("nation"))
    return a.unionByName(s.base("supplier").select(F.lit("supplier").alias("kind"), c("s_nationkey").alias("nation")))


@query("SET2_union_distinct", "select c_nationkey as nation from customer union select s_nationkey from supplier")
def _(s):
    return s.base("customer").select(c("c_nationkey").alias("nation")).union(s.base("supplier").select("s_nationkey")).distinct()


@query("SET3_bind_by_name", "select c_name as name, c_mktsegment as segment from customer union all select s_name, null from supplier")
def _(s):
    a = s.base("customer").select(c("c_name").alias("name"), c("c_mktsegment").alias("segment"))
    return a.unionByName(s.base("supplier").select(c("s_name").alias("name")), allowMissingColumns=True)


@query("SET4_metric_and_negative", """select 'main' as metric_type, l_suppkey, sum(l_quantity) as qty from lineitem group by 2
 union all select 'baseline', l_suppkey, -sum(l_quantity) from lineitem group by 2""", r2="qty")
def _(s):
    return with_baseline(s.base("lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("qty")), "qty")

"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (date_steps, greatest_strict, json_either, json_scalar, least_strict, month_start, next_month_start,
                         parse_datetime, regex_group, safe_divide)
from .registry import query

c = F.col


@query("STR1_case", "select c_custkey, lower(c_name) as low, upper(c_mktsegment) as up from customer")
def _(s):
    return s.base("customer").select("c_custkey", F.lower("c_name").alias("low"), F.upper("c_mktsegment").alias("up"))


@query("STR2_regex_replace", r"""select id, regexp_replace(countries, '[\[\]"]', '', 'g') as country from t_fb_ad_set""")
def _(s):
    return s["fb_ad_set"].select("id", F.regexp_replace("countries", r'[\[\]"]', "").alias("country"))


@query("STR3_regex_extract", "select page_id, nullif(regexp_extract(url, '://([^/]+)/', 1), '') as host from pages")
def _(s):
    return s.base("pages").select("page_id", regex_group("url", "://([^/]+)/").alias("host"))


@query("STR4_split_first", "select message_id, split_part(utm_campaign, ',', 1) as campaign from t_eval_step")
def _(s):
    return s["eval_step"].select("message_id", F.substring_index("utm_campaign", ",", 1).alias("campaign"))


@query("STR5_hashed_id", "select id, md5(trim('  ' || id || ' ')) as hashed from t_customer")
def _(s):
    padded = F.concat(F.lit("  "), c("id"), F.lit(" "))
    return s["customer"].select("id", F.md5(F.trim(padded)).alias("hashed"))


@query("STR6_concat", "select p_partkey, 'contacts_part_' || p_partkey || '.csv' as file from part")
def _(s):
    return s.base("part").select("p_partkey", F.format_string("contacts_part_%d.csv", "p_partkey").alias("file"))


@query("DT1_month_start", "select o_orderkey, date_trunc('month', o_orderdate) as m from orders", dates="m")
def _(s):
    return s.base("orders").select("o_orderkey", month_start("o_orderdate").alias("m"))


@query("DT2_to_date", "select event_id, ts::date as day from events", dates="day")
def _(s):
    return s.base("events").select("event_id", F.to_date("ts").alias("day"))


@query("DT3_add", """select o_orderkey, o_orderdate + interval 7 day as plus_week, o_orderdate - interval 3 month as minus_quarter from orders""",
       dates="plus_week minus_quarter")
def _(s):
    return s.base("orders").select("o_orderkey", F.date_add("o_orderdate", 7).alias("plus_week"), F.add_months("o_orderdate", -3).alias("minus_quarter"))


@query("DT4_diff", "select l_orderkey, l_linenumber, date_diff('day', o_orderdate, l_shipdate) as days from lineitem join orders on l_orderkey = o_orderkey", ints="days")
def _(s):
    joined = s.base("lineitem").join(s.base("orders"), c("l_orderkey") == c("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", F.datediff("l_shipdate", "o_orderdate").cast("long").alias("days"))


@query("DT5_last_day", "select o_orderkey, last_day(o_orderdate) as month_end, last_day(o_orderdate) + 1 as next_month from orders", dates="month_end next_month")
def _(s):
    return s.base("orders").select("o_orderkey", F.last_day("o_orderdate").alias("month_end"), next_month_start("o_orderdate").alias("next_month"))


@query("DT6_minus_hours", "select event_id, ts - interval 24 hour as day_before from events", stamps="day_before")
def _(s):
    return s.base("events").select("event_id", (c("ts") - F.expr("interval 24 hours")).alias("day_before"))


@query("DT7_as_of", "select event_id, ts >= timestamp '2024-01-15 00:00:00' as recent from events")
def _(s):
    as_of = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return s.base("events").select("event_id", (c("ts") >= as_of).alias("recent"))


@query("DT8_parse_datetime", "select message_id, strptime(upper(schedule_date), '%d-%m-%Y %I:%M%p') as booked_at from t_followup", stamps="booked_at")
def _(s):
    return s["followup"].select("message_id", parse_datetime("schedule_date").alias("booked_at"))


@query("DT9_date_array", "select o_orderkey, len(generate_series(o_orderdate, timestamp '2001-08-01', interval 1 day)) as days from orders", ints="days")
def _(s):
    steps = date_steps(F.to_date("o_orderdate"), F.lit("2001-08-01").cast("date"))
    return s.base("orders").select("o_orderkey", F.coalesce(F.size(steps), F.lit(0)).cast("long").alias("days"))


@query("DT10_minus_days", "select o_orderkey, o_orderdate::date - 1 as day_before from orders", dates="day_before")
def _(s):
    return s.base("orders").select("o_orderkey", F.date_sub("o_orderdate", 1).alias("day_before"))


@query("DT11_year_epoch", "select o_orderkey, year(o_orderdate) as y, epoch(o_orderdate) as secs from orders", ints="y secs")
def _(s):
    return s.base("orders").select("o_orderkey", F.year("o_orderdate").cast("long").alias("y"),
                                   F.unix_timestamp(c("o_orderdate").cast("timestamp")).alias("secs"))


@query("MTH1_arithmetic", "select p_partkey, p_size / 7 as a, p_retailprice * 2 - p_size + 1 as b from part", r6="a", r4="b")
def _(s):
    return s.base("part").select("p_partkey", (c("p_size") / 7).alias("a"), (c("p_retailprice") * 2 - c("p_size") + 1).alias("b"))


@query("MTH2_safe_divide", "select l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_tax, 0) as ratio from lineitem", r2="ratio")
def _(s):
    return s.base("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", safe_divide("l_extendedprice", "l_tax").alias("ratio"))


@query("MTH3_round", "select c_custkey, round(c_acctbal, 1) as r1, round(c_acctbal, 0) as r0 from customer", r2="r1 r0")
def _(s):
    return s.base("customer").select("c_custkey", F.round("c_acctbal", 1).alias("r1"), F.round("c_acctbal", 0).alias("r0"))


@query("MTH4_clamp", """select atome_order_id, transaction_amount, case when transaction_amount is not null then greatest(transaction_amount, 0) end as sale,
 case when transaction_amount is not null then abs(least(transaction_amount, 0)) end as refund from t_atome_manual""", r2="transaction_amount sale refund")
def _(s):
    v = c("transaction_amount")
    return s["atome_manual"].select("atome_order_id", v, greatest_strict(v, F.lit(0.0)).alias("sale"), F.abs(least_strict(v, F.lit(0.0))).alias("refund"))


@query("MTH5_abs", "select s_suppkey, abs(s_acctbal) as v from supplier", r2="v")
def _(s):
    return s.base("supplier").select("s_suppkey", F.abs("s_acctbal").alias("v"))


@query("MTH6_ceil_least", "select o_orderkey, ceil((o_orderkey + 1) / 3000) as chunk, least(o_orderkey, 100) as capped from orders", ints="chunk")
def _(s):
    return s.base("orders").select("o_orderkey", F.ceil((c("o_orderkey") + 1) / 3000).alias("chunk"), F.least(c("o_orderkey"), F.lit(100)).alias("capped"))


@query("NUL1_coalesce", "select sys_id, coalesce(prescription_price_id, price_id) as price, coalesce(prescription_id, stripe_subscription_id, 'none') as ref from t_app_order")
def _(s):
    return s["app_order"].select("sys_id", F.coalesce("prescription_price_id", "price_id").alias("price"),
                                 F.coalesce("prescription_id", "stripe_subscription_id", F.lit("none")).alias("ref"))


@query("CST1_casts", """select p_partkey, p_partkey::varchar as a, p_size::double / 4 as b, trunc(p_retailprice) as c, (p_size % 2)::boolean as d,
 try_cast(p_name as bigint) as e from part""", r4="b", ints="c")
def _(s):
    return s.base("part").select("p_partkey", c("p_partkey").cast("string").alias("a"), (c("p_size").cast("double") / 4).alias("b"),
                                 c("p_retailprice").cast("long").alias("c"), (c("p_size") % 2).cast("boolean").alias("d"),
                                 c("p_name").try_cast("long").alias("e"))


@query("JSN1_scalar_path", "select event_id, json_extract_string(props, '$.k')::bigint as k, json_extract_string(props, '$.missing') as missing from events")
def _(s):
    return s.base("events").select("event_id", json_scalar("props", "$.k").cast("long").alias("k"), json_scalar("props", "$.missing").alias("missing"))


@query("JSN2_nested_path", "select sys_id, json_extract_string(webhook_payload, '$.paymentTransaction.orderId') as order_id from t_atome_payments")
def _(s):
    return s["atome_payments"].select("sys_id", json_scalar("webhook_payload", "$.paymentTransaction.orderId").alias("order_id"))


@query("JSN3_object_or_array", """select sys_id, coalesce(json_extract_string(prescription_order_calculation, '$.total'),
 json_extract_string(prescription_order_calculation, '$[0].total'))::bigint as total from t_app_order""")
def _(s):
    return s["app_order"].select("sys_id", json_either("prescription_order_calculation", "total").cast("long").alias("total"))


@query("JSN4_scalar_not_text", """select id, case when json_type(metadata, '$.condition') in ('OBJECT', 'ARRAY') then null
 else json_extract_string(metadata, '$.condition') end as condition from t_product""")
def _(s):
    return s["product"].select("id", json_scalar("metadata", "$.condition").alias("condition"))


@query("JSN5_arrow_operator", "select price_id, price_metadata->>'frequency' as frequency, price_metadata->>'boxes' as boxes from t_price_sheet")
def _(s):
    return s["price_sheet"].select("price_id", F.get_json_object("price_metadata", "$.frequency").alias("frequency"),
                                   F.get_json_object("price_metadata", "$.boxes").alias("boxes"))


@query("JSN6_parse_with_schema", "select event_id, (props->>'k')::bigint as k from events")
def _(s):
    return s.base("events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("ARR1_unnest", "select c_custkey, unnest(string_split(c_name, '#')) as piece from customer")
def _(s):
    return s.base("customer").select("c_custkey", F.explode(F.split("c_name", "#")).alias("piece"))


@query("ARR2_subscript", "select c_custkey, string_split(c_name, '#')[2] as number from customer")
def _(s):
    return s.base("customer").select("c_custkey", F.split("c_name", "#")[1].alias("number"))


@query("MAP1_construction", """select payment_intent_id, string_agg(key || '=' || value, ',' order by key) as entries, count(*) as n from
 (select payment_intent_id, key, max(value) as value from t_intent_metadata where key is not null group by 1, 2) m group by 1""")
def _(s):
    from ..operators.json_fields import map_of_entries
    maps = map_of_entries(s["intent_metadata"], ["payment_intent_id"], "key", "value", "m")
    entries = F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return maps.select("payment_intent_id", F.array_join(entries, ",").alias("entries"), F.size("m").cast("long").alias("n"))

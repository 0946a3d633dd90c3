"""Queries on stored states, logs, sheets and refreshed tables: each builds its state from the tables and reads the result back from it."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..operators.distinct import count_states, distinct_states, number_entities, write_states
from ..operators.funnel import funnel
from ..operators.joins import null_safe_join
from ..operators.lists import in_list, not_in_list
from ..operators.row_diff import differing_buckets, differing_rows
from ..operators.score_log import ScoreLog, score_pending, scored
from ..operators.variants import parse_columns, variant_fields
from ..plans import payments
from ..sources import sheets
from ..sources.snapshots import PartitionedTable
from ..sources.views import create_views, read_query_file, read_view
from ..sources.writers import materialise, materialise_buckets, staged_paths
from .composites import letter_share
from .hubs import AS_OF, START, scalar
from .jobs import lines
from .registry import query, scratch

c = F.col


# --- distinct counts from stored bitmaps ----------------------------------------------------------------------------
@query("AGG3_bitmap_rollup", """select 'day' as grain, event_type, ts::date as period, count(distinct user_id) as n from events group by 2, 3
 union all select 'month', event_type, date_trunc('month', ts)::date, count(distinct user_id) from events group by 2, 3
 union all select 'month, all types', null, date_trunc('month', ts)::date, count(distinct user_id) from events group by 3
 union all select 'all', null, null, count(distinct user_id) from events""", dates="period")
def _(s):
    events = s.base("events").select("event_type", "user_id", F.to_date("ts").alias("day"))
    path = scratch(s, "states")
    write_states(distinct_states(events, number_entities(events, "user_id"), "user_id", ["event_type", "day"]), path)
    # every grain comes from the stored days
    states, month = s.spark.read.parquet(path), F.trunc("day", "MM").cast("date")
    none = lambda kind: F.lit(None).cast(kind)
    grains = {"day": {"event_type": c("event_type"), "period": c("day")}, "month": {"event_type": c("event_type"), "period": month},
              "month, all types": {"event_type": none("string"), "period": month}, "all": {"event_type": none("string"), "period": none("date")}}
    counts = [count_states(states, dims).select(F.lit(grain).alias("grain"), "event_type", "period", "n") for grain, dims in grains.items()]
    return reduce(DataFrame.unionByName, counts)


@query("AGG4_bitmap_segments", """select region, date_trunc('month', purchase_date)::date as month, count(distinct customer_id) as n_customers, count(distinct charge_id) as n_charges
 from h_lines group by 1, 2""", dates="month")
def _(s):
    sales = lines(s).select("region", "sales_channel", c("purchase_date").alias("day"), "customer_id", "charge_id")
    dims, by = ["region", "sales_channel", "day"], {"region": c("region"), "month": F.trunc("day", "MM").cast("date")}
    counts = sales.select(*[col.alias(name) for name, col in by.items()]).distinct()
    # days and channels are merged: a customer of two channels in a month counts once
    for entity, out in (("customer_id", "n_customers"), ("charge_id", "n_charges")):
        states = materialise(distinct_states(sales, number_entities(sales, entity), entity, dims))
        counts = null_safe_join(counts, count_states(states, by, out), list(by)).withColumn(out, F.coalesce(out, F.lit(0)))
    return counts


# --- JSON parsed once -------------------------------------------------------------------------------------------------
@query("JSN3_variant_column", f"""select sys_id, coalesce({scalar('j', '$.total')}, {scalar('j', '$[0].total')})::bigint as total,
 coalesce({scalar('j', '$.subTotal')}, {scalar('j', '$[0].subTotal')})::bigint as sub_total, coalesce({scalar('j', '$.isConsult')}, {scalar('j', '$[0].isConsult')})::boolean as is_consult,
 coalesce({scalar('j', '$.consultFee')}, {scalar('j', '$[0].consultFee')})::bigint as fee, {scalar('u', '$.utmSource')} as source
 from (select sys_id, prescription_order_calculation as j, utm as u from t_app_order) x""")
def _(s):
    parsed = materialise(parse_columns(s["app_order"].select("sys_id", "prescription_order_calculation", "utm"), ["prescription_order_calculation", "utm"]))
    fields = {"total": "bigint", "sub_total": ("subTotal", "bigint"), "is_consult": ("isConsult", "boolean"), "fee": ("consultFee", "bigint")}
    typed = variant_fields(parsed, "prescription_order_calculation_v", fields, strict=True)
    return variant_fields(typed, "utm_v", {"source": ("utmSource", "string")}, or_first_element=False).select("sys_id", *fields, "source")


# --- sheets -----------------------------------------------------------------------------------------------------------
@query("SRC6_cell_range", "select c_custkey, c_acctbal from customer order by c_custkey limit 1000 offset 99", r2="c_acctbal")
def _(s):
    path = scratch(s, "sheet")
    sheets.write_sheet(s.base("customer").select("c_name", "c_custkey", "c_mktsegment", "c_acctbal").orderBy("c_custkey"), path)
    # row 1 is the header, so row 101 holds the hundredth customer
    key = sheets.read_sheet(s.spark, path, "c_custkey long, c_mktsegment string, c_acctbal double", "B101:D1100", header=False)
    return key.select("c_custkey", "c_acctbal")


@query("SRC6_bad_cells", """select row, 'C' || row as cell, 'n/a' as text, 'double' as wanted from (select row_number() over (order by p_partkey) + 1 as row, p_size from part) x
 where p_size % 10 = 0""")
def _(s):
    path = scratch(s, "sheet")
    price = F.when(c("p_size") % 10 == 0, "n/a").otherwise(c("p_retailprice").cast("string"))
    sheets.write_sheet(s.base("part").orderBy("p_partkey").select("p_partkey", "p_brand", price.alias("price")), path)
    return sheets.bad_cells(s.spark, path, "p_partkey long, p_brand string, price double")


@query("SNK3_sheet_sink", "select l_orderkey, l_linenumber, l_partkey, l_shipdate::date as day, l_extendedprice, l_quantity > 25 as many from lineitem", dates="day",
       r2="l_extendedprice")
def _(s):
    path = scratch(s, "sheet")
    rows = s.base("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("day"), "l_extendedprice", (c("l_quantity") > 25).alias("many"))
    sheets.write_sheet(rows, path)
    return sheets.read_sheet(s.spark, path, rows.schema.simpleString()[7:-1].replace(":", " "))


# --- views ------------------------------------------------------------------------------------------------------------
@query("SNK1_catalog_views", """select region, month, n_charges, refunded, refunded / n_charges as share from (select region, date_trunc('month', created)::date as month,
 count(*) as n_charges, count(*) filter (where amount_refunded > 0) as refunded from t_charge where status = 'succeeded' group by 1, 2) x where n_charges > 5""", dates="month", r6="share")
def _(s):
    """Two views from query files, one on the other, read in another session."""
    folder, name = scratch(s, "queries"), uuid.uuid4().hex
    facts = materialise(s["charge"].select("region", "created", "status", "amount_refunded"))
    paths = ", ".join(f"'{p}'" for p in staged_paths(facts))
    texts = {f"monthly_{name}": f"""select region, cast(trunc(created, 'MM') as date) as month, count(*) as n_charges, count_if(amount_refunded > 0) as refunded
              from parquet.{paths.replace("'", "`")} where status = 'succeeded' group by 1, 2;""",
             f"a_share_{name}": f"select *, refunded / n_charges as share from monthly_{name} where n_charges > 5"}
    for view, text in texts.items():
        s.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/{view}.sql")
    # a file written by Spark is a folder; the views come from the files in them
    create_views(s.spark, {view: read_query_file(s.spark, f"{folder}/{view}.sql").strip().rstrip(";") for view in texts})
    return read_view(s.spark.newSession(), f"a_share_{name}")


# --- tables kept in buckets -----------------------------------------------------------------------------------------------
@query("JN2_bucketed_chain", """select c.id as charge_id, i.billing_reason, l.price_id, l.quantity, l.amount from t_charge c left join t_invoice i on i.id = c.invoice_id
 left join t_invoice_line_item l on l.invoice_id = i.id where c.status = 'succeeded'""")
def _(s):
    return invoice_chain(*bucketed_by_invoice(s)).select("charge_id", "billing_reason", "price_id", "quantity", "amount")


def bucketed_by_invoice(s) -> list[DataFrame]:
    """Charges, invoices and invoice lines, each kept in buckets of the invoice they belong to."""
    charge = s["charge"].filter("status = 'succeeded'").select(c("id").alias("charge_id"), "invoice_id")
    invoice = s["invoice"].select(c("id").alias("invoice_id"), "billing_reason")
    line = s["invoice_line_item"].select("invoice_id", "price_id", "quantity", "amount")
    return [materialise_buckets(t, ["invoice_id"]) for t in (charge, invoice, line)]


def invoice_chain(charge: DataFrame, invoice: DataFrame, line: DataFrame) -> DataFrame:
    """The chain of joins over the invoice; every side lies in its buckets, so none is moved."""
    named = invoice.join(line, "invoice_id", "left")
    return charge.join(named, "invoice_id", "left")


# --- refreshed tables -------------------------------------------------------------------------------------------------
@query("SNK4_refreshed_hub", "select * from h_metrics", dates="obs_date created_at ended_at", r6="mrr_local mrr_usd")
def _(s):
    """The hub as it stood before 2000, brought up to date by the months that have changed since."""
    before = {name: s[name] for name in s} | {"subscription_history": s["subscription_history"].filter("valid_from < date '2000-01-01'"),
                                             "charge": s["charge"].filter("created < date '2000-01-01'")}
    hub, spans = payments.subscription_hub(s.spark, s, scratch(s, "hub"))
    payments.refresh_subscription_metrics(before, hub, spans, "2000-01-31", start=START)
    payments.refresh_subscription_metrics(s, hub, spans, AS_OF, previous_as_of="2000-01-31", start=START)
    return hub.read().drop("month")


@query("SNK4_rolled_extract", """select o_orderkey, o_custkey, o_totalprice, o_orderdate::date as day from orders where o_orderdate::date between date '2000-03-30' and date '2000-06-30'""", dates="day", r2="o_totalprice")
def _(s):
    """A rolling extract of three months, made as of one month and rolled on to the next: a month of days is written, a month of folders goes."""
    orders = s.base("orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    table = PartitionedTable(s.spark, scratch(s, "rolling"), orders.schema, ["day"])
    for as_of in ("2000-05-31", "2000-06-30"):
        table.roll(orders.filter(c("day") <= F.lit(as_of).cast("date")), first=F.add_months(F.lit(as_of).cast("date"), -3))
    return table.read()


# --- differences, lists, funnels, scoring ------------------------------------------------------------------------------
CHANGED = """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, case when l_returnflag = 'R' and l_linenumber = 1 then l_extendedprice + 1 else l_extendedprice end as price
 from lineitem where not (l_linestatus = 'F' and l_linenumber = 7)"""
COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, price"


def exported(s):
    return s.base("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", c("l_extendedprice").alias("price"))


def warehoused(s):
    price = F.when((c("l_returnflag") == "R") & (c("l_linenumber") == 1), c("l_extendedprice") + 1).otherwise(c("l_extendedprice"))
    kept = s.base("lineitem").filter(~((c("l_linestatus") == "F") & (c("l_linenumber") == 7)))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", price.alias("price"))


@query("CMP32_differing_rows", f"""select {COLUMNS}, n_left, n_right, case when n_left > 0 and n_right > 0 then 'repeated' when k.r = 0 then 'left only' when k.l = 0 then 'right only' else 'changed' end as kind
 from (select {COLUMNS}, count(*) filter (where side = 1) as n_left, count(*) filter (where side = 2) as n_right from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice as price, 1 as side from lineitem union all select *, 2 from ({CHANGED}) z) x group by all) d
 join (select l_suppkey as s, l_orderkey as o, l_linenumber as i, count(*) filter (where side = 1) as l, count(*) filter (where side = 2) as r from (select l_suppkey, l_orderkey,
  l_linenumber, 1 as side from lineitem union all select l_suppkey, l_orderkey, l_linenumber, 2 from ({CHANGED}) z) y group by all) k
 on k.s = d.l_suppkey and k.o = d.l_orderkey and k.i = d.l_linenumber where n_left <> n_right""", r2="price l_quantity")
def _(s):
    return differing_rows(exported(s), warehoused(s), ["l_suppkey"], ["l_orderkey", "l_linenumber"])


@query("JB72_differing_days", """select channel, day, campaign from (select 'facebook' as channel, date as day, campaign_name as campaign, ad_id, spend from t_fb_levels
 except all select 'facebook', date, campaign_name, ad_id, spend from t_fb_levels where reach > 0 or ctr > 0 or spend > 0) x group by all""", dates="day")
def _(s):
    """Campaign days on which the platform's export and the warehouse's active rows differ."""
    shown = [F.lit("facebook").alias("channel"), c("date").alias("day"), c("campaign_name").alias("campaign"), "ad_id", "spend"]
    active = s["fb_levels"].filter("reach > 0 or ctr > 0 or spend > 0")
    return differing_buckets(s["fb_levels"].select(*shown), active.select(*shown), ["channel", "day", "campaign"])


@query("FLT6_long_list", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_partkey in (select p_partkey from part where p_type <> 'PROMO')")
def _(s):
    listed = s.base("part").filter(c("p_type") != "PROMO")
    return in_list(s.base("lineitem"), "l_partkey", listed, "p_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("FLT7_long_list", "select id, customer_id from t_charge where customer_id not in (select 'cus_' || c_custkey from customer where c_mktsegment <> 'BUILDING')")
def _(s):
    listed = s.base("customer").filter(c("c_mktsegment") != "BUILDING").select(F.concat(F.lit("cus_"), "c_custkey").alias("entry"))
    return not_in_list(s["charge"].select("id", "customer_id"), "customer_id", listed, "entry")


def step(kind: str, before: str) -> str:
    return f"""select distinct e.user_id, e.ts from events e where e.event_type = '{kind}' and exists (select 1 from ({before}) b where b.user_id = e.user_id
 and b.ts < e.ts and b.ts + interval 20 day >= e.ts)"""


VIEWS = "select user_id, ts from events where event_type = 'view'"
CLICKS = step("click", VIEWS)
SIGNUPS = step("signup", CLICKS)
PURCHASES = step("purchase", SIGNUPS)


@query("CMP22_funnel_steps", f"""select user_id, (1 + (time_2 is not null)::int + (time_3 is not null)::int + (time_4 is not null)::int)::bigint as reached, time_1, time_2, time_3, time_4 from
 (select user_id, min(ts) as time_1 from ({VIEWS}) a group by 1) a left join (select user_id, min(ts) as time_2 from ({CLICKS}) b group by 1) b using (user_id)
 left join (select user_id, min(ts) as time_3 from ({SIGNUPS}) d group by 1) d using (user_id) left join (select user_id, min(ts) as time_4 from ({PURCHASES}) e group by 1) e using (user_id)""",
       stamps="time_1 time_2 time_3 time_4")
def _(s):
    found = funnel(s.base("events"), "user_id", "ts", "event_type", ["view", "click", "signup", "purchase"], F.make_dt_interval(days=F.lit(20)))
    return found.withColumn("reached", c("reached").cast("long"))


@query("UDF1_resumed_scoring", r"""select doc_id, length(regexp_replace(text, '[^\p{L}]', '', 'g')) / length(text) as letters, null::varchar as error, 1::bigint as attempt
 from documents""", r6="letters")
def _(s):
    """A first run stops after one of its batches, the second goes on with the rows that the log lacks."""
    docs = s.base("documents").select("doc_id", "text")
    log = ScoreLog(s.spark, scratch(s, "score-log"), docs.schema["doc_id"], StructType([StructField("letters", DoubleType())]))
    size = max(1, docs.count() // 3)
    score_pending(docs, log, ["text"], "text", letter_share, batch_rows=size, max_batches=1)
    score_pending(docs, log, ["text"], "text", letter_share, batch_rows=size)
    return scored(docs, log, ["text"]).select("doc_id", "letters", "error", c("attempt").cast("long").alias("attempt"))

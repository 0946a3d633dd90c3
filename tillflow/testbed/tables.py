"""Shop tables derived from the generic star-schema test tables.

The jobs need a shop's payment, advertising, event and application tables. This module derives them from the test
tables with plain SQL that Spark and DuckDB both read, so the check compares the jobs and not two derivations. Every
derived table is computed over whole test tables. Small reference lists (exchange rates, tax rates, label maps) are
VALUES lists.

``DAYS(d, n)`` is replaced by the engine's "date plus n days".
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources.writers import is_table, stage, staged_paths

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

REGION3 = "case {0} % 3 when 0 then 'sg' when 1 then 'hk' else 'jp' end"
CURRENCY3 = "case {0} % 3 when 0 then 'sgd' when 1 then 'hkd' else 'jpy' end"
K = "cast(substr(props, 7, length(props) - 7) as int)"
CONDITION = ("case {0} when 'ECONOMY' then 'ED' when 'SMALL' then 'PE' when 'STANDARD' then 'Hair Loss' "
             "when 'PROMO' then 'Services' else 'Weight Loss' end")
SOURCE = ("case {0} % 9 when 0 then 'Facebook_ads' when 1 then 'fb' when 2 then 'google_cpc' when 3 then 'ig_story' "
          "when 4 then 'bing' when 5 then 'partner' when 6 then null when 7 then 'chatgpt.com' else 'EDM-1' end")

SQL: dict[str, str] = {}

# --- reference lists -------------------------------------------------------------------------------------------
SQL["t_fx"] = """select * from (values ('sgd', 1.3487e0), ('hkd', 7.8129e0), ('jpy', 151.37e0), ('usd', 1e0))
 as v(currency, fx_to_usd)"""
SQL["t_subunits"] = "select * from (values ('sgd', 100), ('jpy', 1), ('usd', 100)) as v(currency, subunits)"
SQL["t_tax_rates"] = """select region, cast(since as date) as effective_from, rate from (values
 ('sg', '1994-01-01', 0.07e0), ('sg', '1997-07-01', 0.08e0), ('sg', '2000-01-01', 0.09e0),
 ('hk', '1994-01-01', 0e0), ('jp', '1996-04-01', 0.08e0), ('jp', '1999-10-01', 0.1e0)) as v(region, since, rate)"""
SQL["t_condition_type"] = """select * from (values ('ED', 'Subscription', 'subscription_cycle'),
 ('Hair Loss', 'One-Time', 'manual')) as v(condition, purchase_type, billing_reason)"""
SQL["t_condition_map"] = """select * from (values ('hair', 'Hair Loss'), ('ed', 'ED'), ('pe', 'PE'),
 ('weight', 'Weight Loss')) as v(raw_condition, condition)"""

# --- payments --------------------------------------------------------------------------------------------------
SQL["s_sale"] = f"""select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
 cast(o_orderdate as date) as o_day, cast(round(o_totalprice * 100) as bigint) as cents,
 {REGION3.format('o_custkey')} as region, {CURRENCY3.format('o_custkey')} as currency from orders"""
SQL["t_charge"] = """select 'ch_' || o_orderkey as id, region, o_orderdate as created, case when o_orderkey % 23 <> 0 then 'cus_' || o_custkey end as customer_id,
 case o_orderstatus when 'P' then 'failed' else 'succeeded' end as status, cents as amount,
 case o_orderpriority when '5-LOW' then cents when '3-MEDIUM' then cast(floor(cents / 4) as bigint) else 0 end
   as amount_refunded,
 currency, case when o_orderpriority <> '4-NOT SPECIFIED' then 'in_' || o_orderkey end as invoice_id,
 'pi_' || o_orderkey as payment_intent_id, 'txn_' || o_orderkey as balance_transaction_id,
 'Charge ' || o_orderpriority as description, '{"orderId": "ord_' || o_orderkey || '"}' as metadata from s_sale"""
SQL["t_payment_intent"] = """select 'pi_' || o_orderkey as id, region, 'cus_' || o_custkey as customer_id,
 o_orderdate as created, 'Intent ' || o_orderpriority as description,
 case when o_orderpriority not in ('4-NOT SPECIFIED', '5-LOW') then '{}'
   when o_orderkey % 2 = 0 then '{"paymentIntentPriceId": "price_' || o_custkey || '"}'
   else '{"stripePriceIds": "price_' || o_custkey || '"}' end as metadata from s_sale"""
SQL["t_balance_transaction"] = """select 'txn_' || o_orderkey as id, region, 'charge' as type, cents as amount,
 cast(floor(cents * 34 / 1000) as bigint) as fee, currency from s_sale"""
SQL["t_invoice"] = f"""select 'in_' || o_orderkey as id, region, 'cus_' || o_custkey as customer_id, o_orderdate as created,
 case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'sub_' || o_custkey || '_' || year(o_day) end as subscription_id,
 case o_orderpriority when '1-URGENT' then 'subscription_create' when '2-HIGH' then 'subscription_cycle'
   else 'manual' end as billing_reason,
 case o_orderpriority when '3-MEDIUM' then 0 else cents + 500 end as subtotal
 from s_sale where o_orderpriority <> '4-NOT SPECIFIED'"""
SQL["t_invoice_line_item"] = """select 'in_' || l_orderkey as invoice_id,
 case when l_returnflag = 'R' then 'si_' || l_suppkey end as subscription_id, 'price_' || l_partkey as price_id,
 'plan_' || l_partkey as plan_id, cast(l_quantity as bigint) as quantity,
 cast(round(l_extendedprice * 100) as bigint) as amount from lineitem"""
SQL["t_price"] = f"""select 'price_' || p_partkey as id, {REGION3.format('p_size')} as region, 'prod_' || p_partkey as product_id,
 cast(round(p_retailprice * 100) as bigint) as unit_amount, {CURRENCY3.format('p_size')} as currency,
 p_brand as nickname, case p_type when 'ECONOMY' then 'month' when 'SMALL' then 'year' end as recurring_interval,
 cast(p_size % 6 + 1 as bigint) as recurring_interval_count,
 case when p_size % 4 = 0 then '{{}}' else '{{"boxes": "' || (p_size % 5 + 1) || '"}}' end as metadata from part"""
SQL["t_product"] = f"""select 'prod_' || p_partkey as id, {REGION3.format('p_size')} as region,
 case p_type when 'PROMO' then 'Teleconsultation ' || p_name else p_name end as name, p_size % 7 <> 0 as active,
 case when p_size = 50 then '{{"condition": {{"code": 1}}}}' when p_size = 49 then '{{"condition": "[Sample] kit"}}'
   when p_size = 48 then '{{"condition": ["ED", "PE"]}}' when p_size = 47 then '{{"condition": null}}' when p_size = 46 then '{{"condition": 12.5}}'
   when p_size = 45 then '{{"condition": "{{trial}}"}}' when p_type = 'LARGE' then '{{"note": "none"}}'
   else '{{"condition": "' || {CONDITION.format('p_type')} || '"}}' end as metadata from part"""
SQL["t_plan"] = f"""select 'plan_' || p_partkey as id, {REGION3.format('p_size')} as region, {CURRENCY3.format('p_size')} as currency,
 case p_type when 'ECONOMY' then 'month' when 'SMALL' then 'year' when 'STANDARD' then 'week' when 'PROMO' then 'day'
   when 'MEDIUM' then 'month' else 'quarter' end as plan_interval,
 cast(case when p_size % 5 = 0 then null else p_size % 6 + 1 end as bigint) as interval_count,
 'prod_' || (p_partkey % 10) as product_id, cast(round(p_retailprice * 100) as bigint) as amount,
 case when p_size % 4 = 0 then '{{}}' else '{{"boxes": "' || (p_size % 5 + 1) || '"}}' end as metadata from part"""
SQL["t_customer"] = f"""select 'cus_' || c_custkey as id, {REGION3.format('c_custkey')} as region, c_name as name,
 'user' || c_custkey || '@example.com' as email, '+65' || c_custkey as phone from customer"""
SQL["t_patient"] = """select 'pat_' || c_custkey as sys_id, 'cus_' || c_custkey as stripe_customer_id,
 case c_mktsegment when 'BUILDING' then 'alpha' when 'MACHINERY' then null else 'beta' end as from_platform_env,
 'user' || c_custkey || '@example.com' as email from customer"""

SQL["t_intent_metadata"] = """select 'pi_' || o_orderkey as payment_intent_id, case when o_orderpriority
 not in ('4-NOT SPECIFIED', '5-LOW') then 'other' when o_orderkey % 2 = 0 then 'paymentIntentPriceId' else 'stripePriceIds' end as key,
 'price_' || o_custkey as value from orders"""
SQL["t_price_metadata"] = """select 'price_' || p_partkey as price_id, 'boxes' as key, cast(p_size as string) as value from part
 union all select 'price_' || p_partkey, 'brand', p_brand from part where p_size % 3 = 0"""
SQL["t_refund"] = """select 'ch_' || l_orderkey as charge_id, cast(round(l_extendedprice * 100) as bigint) as amount
 from lineitem where l_returnflag = 'R' and l_linenumber = 2"""

# --- subscriptions: one per customer and year with urgent or high orders, one history version per order ---------
SQL["s_version"] = """select 'sub_' || o_custkey || '_' || year(o_day) as id, region, 'cus_' || o_custkey as customer_id,
 case o_orderstatus when 'O' then 'active' when 'F' then 'canceled' else 'past_due' end as status, o_orderkey, o_day
 from s_sale where o_orderpriority in ('1-URGENT', '2-HIGH')"""
SQL["t_subscription_history"] = """select v.id, v.region, v.customer_id, v.status, f.created,
 case v.status when 'canceled' then DAYS(v.o_day, 30 + cast(v.o_orderkey % 150 as int)) end as ended_at,
 'in_' || v.o_orderkey as latest_invoice_id, v.o_day as valid_from,
 coalesce(lead(v.o_day) over (partition by v.id order by v.o_day, v.o_orderkey),
   DAYS(v.o_day, 30 + cast(v.o_orderkey % 150 as int))) as valid_to
 from s_version v join (select id, min(o_day) as created from s_version group by id) f on v.id = f.id"""
SQL["t_subscription_item"] = """select 'sub_' || o_custkey || '_' || year(o_day) as subscription_id,
 'plan_' || o_custkey as plan_id, cast(o_orderkey % 4 as bigint) as quantity
 from s_sale where o_orderpriority in ('1-URGENT', '2-HIGH')"""

SQL["t_subscription_price"] = """select subscription_id, min(replace(plan_id, 'plan', 'price')) as price_id
 from t_subscription_item group by subscription_id"""

# --- the payment tables that hold no region of their own, and charges put on invoices by hand ----------------------
SQL["t_regional_subscription_item"] = "select p.region, i.* from t_subscription_item i join t_plan p on p.id = i.plan_id"
SQL["t_regional_invoice_line_item"] = """select p.region, l.invoice_id || '_' || l.price_id as id, l.* from t_invoice_line_item l
 join t_price p on p.id = l.price_id"""
SQL["t_invoice_item"] = f"""select {REGION3.format('l_suppkey')} as region, 'ii_' || l_orderkey || '_' || l_linenumber as id, 'in_' || l_orderkey as invoice_id,
 cast(round(l_extendedprice * 10) as bigint) as amount from lineitem where l_returnflag = 'A'"""

# --- product costs ----------------------------------------------------------------------------------------------
SQL["s_cost"] = """select p_partkey, p_size, floor(round(p_retailprice * 100) * 200 / 1000) / 100e0 as cost, 1 + p_size * 0.05e0 as packaging,
 cast('1994-01-01' as date) as since from part
 union all select p_partkey, p_size, floor(round(p_retailprice * 100) * 250 / 1000) / 100e0, 1 + p_size * 0.06e0,
 DAYS(cast('1998-01-01' as date), p_size) from part"""
SQL["t_product_cost"] = f"""select {REGION3.format('p_size')} as region, 'prod_' || p_partkey as id, 'SKU-' || p_partkey as sku,
 cost as cost_box, packaging as packaging_cost, since as effective_date from s_cost
 union all select 'th', 'prod_' || p_partkey, 'SKU-' || p_partkey, cost * 2, packaging, since from s_cost where p_size % 7 = 0"""
SQL["t_marketplace_cogs"] = f"""select p_partkey, 'sku-' || p_partkey as sku, 'Item ' || p_partkey as product_name, cost as cogs,
 packaging, case p_size % 3 when 0 then 'ED' when 1 then 'Hair Loss' else null end as condition,
 since as effective_date from s_cost"""
SQL["t_lazada_cogs"] = "select sku as seller_sku, product_name, cogs, packaging, effective_date from t_marketplace_cogs"
SQL["t_shopee_cogs"] = """select sku as sku_reference_no_, p_partkey as product_id, condition, cogs, packaging, effective_date
 from t_marketplace_cogs"""
SQL["t_tiktok_costs"] = "select p_partkey as sku_id, product_name, cogs, packaging, effective_date from t_marketplace_cogs"
SQL["t_tiktok_cogs"] = "select p_partkey as sku_id, 'Item ' || p_partkey as product_name, p_size * 1.5e0 as cogs from part"
SQL["t_price_cogs"] = """select 'price_' || p_partkey as price_id, p_size * 2.5e0 as cogs, 0.02e0 as cashback, 0.07e0 as gst_vat
 from part where p_size % 9 <> 0"""

# --- channel sheets ---------------------------------------------------------------------------------------------
SQL["t_tiktok_orders"] = """select l_orderkey as order_id, cast(l_shipdate as date) as created_time,
 'buyer_' || l_suppkey as buyer_username, l_partkey as sku_id, cast(l_quantity as bigint) as quantity, case when l_linenumber = 7 then 'USD' else 'SGD' end as currency,
 l_extendedprice as revenue, floor(round(l_extendedprice * 100) * round((1 - l_discount) * 100) / 100) / 100e0 as sku_subtotal_after_discount,
 case when l_linenumber = 1 then floor(round(l_extendedprice * 100) * 500 / 1000) / 100e0 end as order_refund_amount,
 -floor(round(l_extendedprice * 100) * 30 / 1000) / 100e0 as payment_gateway_fee from lineitem where l_returnflag = 'A'"""
SQL["t_lazada_orders"] = """select cast(l_shipdate as date) as transaction_date,
 case l_linenumber when 1 then 'Orders-Lazada Fees' when 2 then 'Orders-Logistics' when 3 then 'Refunds-Claims'
   when 4 then 'Orders-Marketing Fees' else 'Orders-Sales' end as transaction_type,
 'sku-' || (l_partkey % 40) as seller_sku, case when l_linenumber = 7 then 'USD' else 'SGD' end as currency,
 case when l_linenumber <= 4 then -floor(round(l_extendedprice * 100) * 100 / 1000) / 100e0 else l_extendedprice end as amount
 from lineitem where l_returnflag = 'N'"""
SQL["t_shopee_orders"] = """select 'sh_' || o_orderkey as order_id, o_orderdate as payout_completed_date,
 'shop_' || o_custkey as username_buyer_, o_custkey as product_id, 'Shop item ' || o_custkey as product_name,
 case when o_custkey % 11 = 0 then 'USD' else 'SGD' end as currency, floor(round(o_totalprice * 100) * 100 / 1000) / 100e0 as product_price,
 case o_orderstatus when 'F' then floor(round(o_totalprice * 100) * 50 / 1000) / 100e0 else 0e0 end as refund_amount,
 -1.5e0 as commission_fee, -0.5e0 as service_fee, -0.25e0 as transaction_fee, 0e0 as ams_fee
 from orders where o_orderpriority = '5-LOW'"""
SQL["t_shopee_quantities"] = """select 'sh_' || o_orderkey as order_id, 'sku-' || o_custkey as sku_reference_no_,
 cast(o_orderkey % 3 + 1 as bigint) as quantity from orders where o_orderpriority = '5-LOW' and o_orderstatus <> 'O'"""
SQL["t_cod_sg_old"] = """select o_day as purchase_date, 'user' || o_custkey || '@example.com' as email,
 case when o_custkey % 11 = 0 then 'USD' else 'SGD' end as currency,
 cast(o_orderkey % 3 + 1 as bigint) as quantity, 'prod_' || o_custkey as product_id, floor(cents / 10) / 100e0 as purchase_amount
 from s_sale where o_orderpriority = '4-NOT SPECIFIED' and o_day < cast('1998-01-01' as date)"""
SQL["t_cod_sg_new"] = """select o_day as date, 'user' || o_custkey || '@example.com' as email,
 case when o_custkey % 11 = 0 then 'USD' else 'SGD' end as currency,
 cast(o_orderkey % 3 + 1 as bigint) as quantity, 'prod_' || o_custkey as product_id, floor(cents / 10) / 100e0 as revenue
 from s_sale where o_orderpriority = '4-NOT SPECIFIED' and o_day >= cast('1998-01-01' as date)"""
SQL["t_cod_hk_old"] = """select o_day as purchase_date, 'user' || o_custkey || '@example.com' as email, 'HKD' as currency,
 cast(o_orderkey % 3 + 1 as bigint) as quantity, 'prod_' || o_custkey as product_id, cents / 100e0 as purchase_amount
 from s_sale where o_orderpriority = '3-MEDIUM' and o_day < cast('1998-01-01' as date)"""
SQL["t_airway_bills"] = """select o_day as delivery_date, 'user' || o_custkey || '@example.com' as email, 'awb_' || o_orderkey as awb_no
 from s_sale where o_orderpriority = '3-MEDIUM' and o_day >= cast('1998-01-01' as date)"""
SQL["t_airway_lines"] = """select 'awb_' || l_orderkey as awb_no, 'sku-' || l_partkey as sku, cast(l_quantity as bigint) as quantity,
 l_extendedprice as revenue from lineitem"""
SQL["t_atome_manual"] = """select 'at_' || o_orderkey as atome_order_id, o_orderkey as short_id, o_day as transaction_time,
 floor(cents / 5) / 100e0 as transaction_amount, case when o_custkey % 11 = 0 then 'USD' else 'SGD' end as currency, -2e0 as sponsored_voucher_amount, -1.5e0 as mdr_fee,
 -0.2e0 as flat_fee from s_sale where o_orderpriority = '2-HIGH'
 union all select 'at_' || o_orderkey, o_orderkey, DAYS(o_day, 5), -floor(cents / 20) / 100e0,
 case when o_custkey % 11 = 0 then 'USD' else 'SGD' end, 0e0, 0e0, 0e0
 from s_sale where o_orderpriority in ('2-HIGH', '5-LOW') and o_orderstatus = 'F'"""
SQL["t_delivery_cost"] = """select cast(date_trunc('month', o_day) as date) as date, upper(region) as country, upper(currency) as currency,
 count(*) * 3.5e0 as cost from s_sale group by 1, 2, 3"""
SQL["t_opex"] = """select cast(date_trunc('month', o_day) as date) as date, upper(region) as country, upper(currency) as currency,
 count(*) * -11e0 as teleconsultation_fees, count(*) * -2.5e0 as dispensing_fees,
 count(*) * -40e0 as operating_expense, count(*) * -55e0 as staff_cost from s_sale group by 1, 2, 3"""

# --- events and application tables --------------------------------------------------------------------------------
# The events are moved back 25 years so that they overlap with the orders.
SQL["s_event"] = """select event_id, ts - interval '9131' day as ts, user_id, event_type, value, props from events"""
SQL["t_tracks"] = """select 'm_' || event_id as message_id, 'u_' || user_id as user_id,
 case event_type when 'signup' then 'Evaluation Updated' when 'purchase' then 'Viewed 4th Question Of Eval'
   else event_type end as event, ts from s_event"""
SQL["t_page_event"] = f"""select 'm_' || event_id as message_id, 'u_' || user_id as user_id, ts,
 case {K} % 4 when 0 then 'Upgrade Introduction Page' when 1 then 'Select Upgrade Plans Page'
   when 2 then 'Health Profile - hair - Step ' || {K} else 'Home' end as name,
 case when {K} % 10 = 0 then 'Upgrade Introduction Page' else 'Shop' end as category,
 {REGION3.format('user_id')} as region, 'Product ' || {K} as product,
 case when {K} % 2 = 0 then 'prod_' || {K} end as product_id, case when {K} % 3 = 0 then 'web' else 'app' end as platform,
 {SOURCE.format(K)} as context_campaign_source,
 case {K} % 5 when 0 then 'paid_cpc' when 1 then 'email' when 2 then null when 3 then 'native-x' else 'social' end
   as context_campaign_medium from s_event where event_type in ('view', 'click')"""
SQL["t_eval_step"] = f"""select 'm_' || event_id as message_id, {REGION3.format('user_id')} as region,
 case {K} % 4 when 0 then 'hair' when 1 then 'ed' when 2 then 'pe' else 'sleep' end as evaluation_type,
 {SOURCE.format(K)} as utm_source, 'Supplier#' || lpad(cast({K} as string), 9, '0') || '_' || event_id || ',x'
   as utm_campaign from s_event where event_type = 'purchase'"""
SQL["t_checkout"] = f"""select 'm_' || event_id as message_id, 'ord_' || event_id as order_id, {REGION3.format('user_id')} as country,
 {REGION3.format('user_id')} as region, {SOURCE.format(K)} as utm_source from s_event where event_type = 'purchase'"""
SQL["t_checkout_product"] = f"""select 'm_' || event_id as message_id, case {K} % 3 when 0 then 'Shampoo' else 'Teleconsultation' end as name,
 case {K} % 4 when 0 then 'hair' when 1 then 'ed' when 2 then 'teleconsultation' else 'sleep' end as condition
 from s_event where event_type = 'purchase'"""
SQL["t_order_completed"] = f"""select 'm_' || event_id as message_id, 'ord_' || event_id as order_id, {REGION3.format('user_id')} as country
 from s_event where event_type in ('click', 'purchase')"""
SQL["t_signed_up"] = f"""select 'm_' || event_id as message_id, {REGION3.format('user_id')} as region, {SOURCE.format(K)} as utm_source,
 case {K} % 4 when 0 then 'hair' when 1 then 'ed' when 2 then 'pe' else 'sleep' end as condition
 from s_event where event_type = 'signup'"""
SQL["t_evaluation_updated"] = f"""select 'm_' || event_id as message_id, case when {K} % 3 = 0 then 'web' else 'app' end as platform,
 {REGION3.format('user_id')} as region, case {K} % 4 when 0 then 'hair' when 1 then 'ed' when 2 then 'pe' else 'sleep' end
   as evaluation_type from s_event where event_type = 'signup'"""
SQL["t_followup"] = f"""select 'm_' || event_id as message_id, lpad(cast(event_id % 28 + 1 as string), 2, '0') || '-' ||
 lpad(cast(event_id % 12 + 1 as string), 2, '0') || '-2024 ' || lpad(cast(event_id % 12 + 1 as string), 2, '0') || ':' ||
 lpad(cast(event_id % 60 as string), 2, '0') || case when event_id % 2 = 0 then 'am' else 'PM' end as schedule_date,
 {REGION3.format('user_id')} as region, 'web' as platform, 'Follow up' as product_name,
 case when {K} % 2 = 0 then 'video' else 'text' end as consult_type from s_event where event_type = 'error'"""
SQL["t_attendance"] = f"""select 'm_' || event_id as message_id, case when {K} % 3 = 0 then 'no-show' else 'attended' end as attendance
 from s_event where event_type = 'view' and value > 3"""
SQL["t_app_order"] = f"""select 'ord_' || o_orderkey as sys_id, o_orderkey as short_id, 'pat_' || o_custkey as patient_id,
 o_orderdate as created_at, case o_orderstatus when 'P' then 'pending_prescription' when 'O' then 'open' else 'done' end
   as status, region, region as country, case o_orderpriority when '5-LOW' then 'cod' when '2-HIGH' then 'atome'
   else 'card' end as payment_provider, 'price_' || o_custkey as price_id,
 case when o_orderpriority = '2-HIGH' then 'price_' || (o_custkey - o_custkey % 2) end as prescription_price_id,
 case when o_orderstatus = 'F' then 'rx_' || o_orderkey end as prescription_id,
 case when o_orderpriority = '1-URGENT' then 'sub_' || o_custkey || '_' || year(o_day) end as stripe_subscription_id,
 'pi_' || o_orderkey as stripe_payment_intent_id, '+65' || o_custkey as phone_number, 'ev_' || (o_orderkey % 5) as evaluation_id,
 'agent_' || (o_orderkey % 3) as updated_by, '{{"utmSource": "' || coalesce({SOURCE.format('o_orderkey')}, '') || '"}}' as utm,
 case o_orderstatus when 'F' then '[' when 'P' then '' else '' end || '{{"total": ' || cents || ', "mainTax": ' ||
   (o_orderkey % 90) || ', "subTotal": "' || (cents - 100) || '", "isConsult": ' ||
   case when o_orderkey % 2 = 0 then 'true' else 'false' end || ', "cashbackEarnRate": 0.0' || (o_orderkey % 9) ||
   case when o_orderkey % 3 = 0 then ', "consultFee": 900' else ', "consultFee": {{"v": 1}}' end || '}}' ||
   case o_orderstatus when 'F' then ']' else '' end as prescription_order_calculation from s_sale"""
SQL["t_price_sheet"] = f"""select 'price_' || p_partkey as price_id, p_name as product_name, '{{"frequency": "' || p_type ||
 '", "dosage": "' || p_size || 'mg", "boxes": ' || (p_size % 5) || '}}' as price_metadata from part"""
SQL["t_atome_payments"] = """select 'ap_' || o_orderkey as sys_id, 'ord_' || o_orderkey as ordersysid, 'pat_' || o_custkey as patientsysid,
 case o_orderstatus when 'F' then 'PAID' else 'PENDING' end as status, cents as amount, o_orderdate as created_at,
 o_orderdate as updated_at, '{"refundableAmount": ' || cents || ', "merchantReferenceId": "' || case o_orderkey % 3 when 0 then '{A-' || o_orderkey || '}' when 1 then '[r] ' || o_orderkey
   else 'mr_' || o_orderkey end || '", "paymentTransaction": {"tenor": ' || (o_orderkey % 12) || ', "orderId": "o_' || o_orderkey ||
 '", "createAt": 1700000000000, "transactionId": "t_' || o_orderkey || '"}}' as webhook_payload
 from s_sale where o_orderpriority = '2-HIGH'"""
SQL["t_consult_session"] = f"""select 'cs_' || event_id as sys_id, {REGION3.format('user_id')} as region, ts as created_at,
 case when {K} % 2 = 0 then 'initial' else 'follow_up' end as consultation_session_type, 'ord_' || event_id as order_sys_id,
 'done' as consultation_session_status, case when value > 5 then 'complete' else 'waiting' end as progress_status,
 'ca_' || event_id as consultation_audit_id from s_event where event_type in ('view', 'signup')"""
SQL["t_consult_audit"] = f"""select 'ca_' || event_id as sys_id, case when {K} % 2 = 0 then 'video' else 'text' end as consult_type,
 'approved' as status, case {K} % 4 when 0 then 'hair' when 1 then 'ed' when 2 then 'pe' else 'sleep' end as evaluation_id,
 {REGION3.format('user_id')} as region from s_event where event_type = 'view'"""
SQL["t_appointment"] = f"""select 'appt_' || user_id as id, {REGION3.format('user_id')} as region, ts as updated_at, 'm_' || event_id as version_id,
 event_type as status from s_event"""
SQL["t_user"] = f"""select 'usr_' || event_id as sys_id, 'user' || user_id || '@example.com' as email, {SOURCE.format(K)} as utm_source,
 ts as updated_at, {REGION3.format('user_id')} as region from s_event"""
SQL["t_refresh_task"] = """select 'task_' || event_id as id, case when user_id % 3 = 0 then user_id end as datasource_id,
 case when user_id % 3 <> 0 then user_id end as workbook_id, ts as schedule_next_run_at, ts as synced_at,
 case when event_type = 'error' then true when event_type = 'view' then cast(null as boolean) else false end as deleted from s_event"""
SQL["t_data_source"] = "select c_custkey as id, 'Source ' || c_custkey as name from customer"
SQL["t_workbook"] = "select c_custkey as id, 'Book ' || c_custkey as name from customer"

# --- advertising ------------------------------------------------------------------------------------------------------
SQL["t_google_stats"] = """select l_suppkey as id, l_suppkey % 25 as customer_id, l_partkey as ad_id, cast(l_shipdate as date) as date,
 cast(l_quantity as bigint) as clicks, cast(l_quantity * 40 as bigint) as impressions,
 cast(round(l_extendedprice * 10000) as bigint) as cost_micros, floor(round(l_extendedprice * 100) * 20 / 1000) / 100e0 as conversions_value
 from lineitem where l_linestatus = 'O'"""
SQL["t_google_campaign"] = """select s_suppkey as id, s_name || ' draft' as name, cast('1995-01-01' as date) as updated_at from supplier
 union all select s_suppkey, s_name, cast('1996-01-01' as date) from supplier"""
SQL["t_google_account"] = """select n_nationkey as id, 'USD' as currency_code, cast('1995-01-01' as date) as updated_at from nation
 union all select n_nationkey, case n_nationkey % 3 when 0 then 'SGD' when 1 then 'HKD' else 'JPY' end,
 cast('1996-01-01' as date) from nation"""
SQL["t_google_target"] = """select s_suppkey as campaign_id, s_nationkey as geo_target_id, cast('1995-01-01' as date) as updated_at
 from supplier where s_suppkey % 10 <> 0 union all
 select s_suppkey, case when s_suppkey % 4 = 0 then null else (s_nationkey + 1) % 25 end, cast('1996-01-01' as date) from supplier
 union all select s_suppkey, (s_nationkey + 2) % 25, cast('1996-01-01' as date) from supplier where s_suppkey % 3 = 0"""
SQL["t_geo_target"] = """select n_nationkey as id, case n_nationkey % 3 when 0 then 'SG' when 1 then 'HK' else 'JP' end as country_code
 from nation"""
SQL["t_fb_levels"] = """select cast(l_shipdate as date) as date, l_partkey as ad_id, l_suppkey % 25 as account_id,
 'Supplier#' || lpad(cast(l_suppkey as string), 9, '0') as campaign_name,
 case when l_linenumber = 7 then 0 else cast(l_quantity * 30 as bigint) end as reach,
 cast(l_quantity * 40 as bigint) as impressions, case when l_linenumber = 7 then 0e0 else l_discount * 10 end as ctr,
 case when l_linenumber = 7 and l_discount < 0.05e0 then 0e0 else floor(round(l_extendedprice * 100) * 10 / 1000) / 100e0 end as spend
 from lineitem where l_linestatus = 'F'"""
SQL["t_fb_ad"] = """select p_partkey as id, p_size as ad_set_id, p_partkey % 97 as creative_id,
 DAYS(cast('2001-01-01' as date), cast(p_partkey % 200 as int)) as created_time, cast('1995-01-01' as date) as updated_time from part
 union all select p_partkey, p_size % 50 + 1, p_partkey % 97, DAYS(cast('2001-01-01' as date), cast(p_partkey % 200 as int)),
 cast('1996-01-01' as date) from part"""
SQL["t_fb_ad_set"] = """select p_size as id, case p_size % 4 when 0 then '["SG"]' when 1 then '["HK"]' when 2 then '["JP"]' end
 as countries, max(cast('1995-01-01' as date)) as updated_time from part group by 1, 2"""
SQL["t_fb_account"] = """select n_nationkey as id, case n_nationkey % 3 when 0 then 'SGD' when 1 then 'HKD' else 'JPY' end as currency,
 cast('1995-01-01' as date) as created_time from nation"""
SQL["t_fb_purchase"] = """select cast(l_shipdate as date) as date, l_partkey as ad_id, floor(round(max(l_extendedprice) * 100) * 30 / 1000) / 100e0 as value
 from lineitem where l_linestatus = 'F' group by 1, 2"""
SQL["t_taboola_report"] = """select o_day as date, o_custkey % 100 as campaign_id, upper(currency) as currency, cast(o_orderkey % 50 as bigint) as clicks,
 cast(o_orderkey % 50 * 60 as bigint) as impressions, floor(cents / 100) / 100e0 as spent from s_sale where o_orderpriority = '5-LOW'"""
SQL["t_taboola_campaign"] = "select s_suppkey as id, s_name as name from supplier"
SQL["t_taboola_target"] = """select s_suppkey as campaign_id, case s_suppkey % 3 when 0 then 'SG' when 1 then 'HK' else 'JP' end as value from supplier
 where s_suppkey % 7 <> 0 union all select s_suppkey, case s_suppkey % 3 when 0 then 'HK' when 1 then 'JP' else 'SG' end from supplier where s_suppkey % 4 = 0"""
SQL["t_manual_spend"] = """select o_day as date, case when o_orderkey % 2 = 0 then 'edm' else 'menarini' end as supplier,
 case when o_orderkey % 3 = 0 then 'ED' end as condition, upper(currency) as currency, upper(region) as country,
 floor(cents / 200) / 100e0 as amount from s_sale where o_orderpriority = '4-NOT SPECIFIED'"""
SQL["t_campaign_condition"] = """select s_name as campaign_name, case when s_suppkey % 2 = 0 then 'google_ads' else 'facebook_ads' end as channel,
 case s_suppkey % 5 when 0 then 'ED' when 1 then 'PE' when 2 then 'Hair Loss' else 'Weight Loss' end as condition
 from supplier where s_suppkey % 7 <> 0"""
SQL["t_fb_campaign_daily"] = """select date, campaign_name, account_id, sum(spend) as spend, sum(impressions) as impressions, max(ctr) as ctr
 from t_fb_levels group by 1, 2, 3"""

_DAYS = re.compile(r"DAYS\((cast\('[0-9-]+' as date\)|[a-z_.]+), ((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)")


def referenced(sql: str, known: Mapping[str, str]) -> list[str]:
    """Names from ``known`` that a query uses, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[a-z]+_[a-z0-9_]+\b", text)):
            if name in known and name not in order:
                visit(known[name])
                order.append(name)

    visit(sql)
    return order


def with_tables(sql: str, known: Mapping[str, str] = SQL) -> str:
    """The query with the derived tables it uses as leading CTEs."""
    names = referenced(sql, known)
    return sql if not names else "with " + ",\n".join(f"{n} as ({known[n]})" for n in names) + "\n" + sql


def duckdb_text(sql: str) -> str:
    return _DAYS.sub(r"(\1 + (\2))", sql)


def spark_text(sql: str, sf_dir: str) -> str:
    sql = _DAYS.sub(r"date_add(\1, \2)", sql)
    return re.sub(rf"\b(from|join) ({'|'.join(BASE)})\b", lambda m: f"{m[1]} parquet.`{sf_dir}/{m[2]}.parquet`", sql)


# (application, data folder, hub) to the folder of its snapshot
_HUB_PATHS: dict[tuple[str, str, str], str] = {}
# the same for derived tables that are written before jobs are timed
_TABLE_PATHS: dict[tuple[str, str, str], str] = {}


def write_tables(spark: SparkSession, sf_dir: str) -> None:
    """Write every derived table as parquet, so that jobs read it like a table and do not derive it."""
    shop = ShopTables(spark, sf_dir)
    for name in shop:
        _TABLE_PATHS[spark.sparkContext.applicationId, shop.sf_dir, name] = stage(shop[name])


def forget_hubs() -> None:
    """Have every hub built anew, as for timing a job from its source tables."""
    _HUB_PATHS.clear()


class ShopTables(Mapping[str, DataFrame]):
    """The derived tables as Spark frames: ``shop["charge"]`` is the table ``t_charge``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def hub(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A hub several jobs share: written once per application to the checkpoint folder, then read back."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _HUB_PATHS:
            hub = build()
            staged = staged_paths(hub) if is_table(hub) else []
            _HUB_PATHS[key] = staged[0] if staged else stage(hub)
        return self.spark.read.parquet(_HUB_PATHS[key])

    def base(self, name: str) -> DataFrame:
        """A test table itself."""
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if f"t_{name}" not in SQL:
            raise KeyError(name)
        written = _TABLE_PATHS.get((self.spark.sparkContext.applicationId, self.sf_dir, name))
        if name not in self._frames and written:
            self._frames[name] = self.spark.read.parquet(written)
        if name not in self._frames:
            self._frames[name] = self.spark.sql(spark_text(with_tables(f"select * from t_{name}"), self.sf_dir))
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return (n[2:] for n in SQL if n.startswith("t_"))

    def __len__(self) -> int:
        return sum(n.startswith("t_") for n in SQL)

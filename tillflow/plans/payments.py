"""Jobs on the payment tables: subscriptions, charges, prices, exports.

Every job takes a mapping of table name to frame; relative-time jobs take an explicit ``as_of``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import json_scalar, month_start
from ..operators.calendar import expand_intervals, fill_months
from ..operators.dedup import latest_per_key
from ..operators.joins import null_safe_join
from ..operators.json_fields import map_of_entries
from ..operators.money import minor_to_usd, with_rate
from ..operators.row_diff import differing_rows
from ..operators.sequence import (attribute_history, conversion_share, detect_increase, sequence_events, share_of_groups)
from ..operators.subscriptions import effective_end, month_observations, monthly_recurring
from ..operators.sweep import by_day, levels, signed_events, stretches
from ..sources.regions import all_regions
from ..sources.snapshots import PartitionedTable
from ..sources.writers import Stages, materialise

Tables = Mapping[str, DataFrame]

# First day of the daily snapshots.
CALENDAR_START = "2020-08-01"

# Tables that exist once per region.
PAYMENT_TABLES = ["subscription_history", "subscription_item", "charge", "plan", "invoice", "product", "invoice_item",
                  "payment_intent", "price", "invoice_line_item", "customer", "balance_transaction"]
# Column subsets of the two tables whose regional shapes differ.
PAYMENT_COLUMNS = {
    "payment_intent": [
        "_fivetran_synced", "amount", "amount_capturable", "amount_received", "application", "application_fee_amount",
        "canceled_at", "cancellation_reason", "capture_method", "confirmation_method", "connected_account_id", "created",
        "currency", "customer_id", "description", "id", "last_payment_error_charge_id", "last_payment_error_code",
        "last_payment_error_decline_code", "last_payment_error_doc_url", "last_payment_error_message",
        "last_payment_error_param", "last_payment_error_source_id", "last_payment_error_type", "livemode", "metadata",
        "on_behalf_of", "payment_method_id", "payment_method_types", "source_id", "statement_descriptor", "status",
        "transfer_data_destination", "transfer_group"],
    "balance_transaction": [
        "id", "connected_account_id", "amount", "available_on", "created", "currency", "description", "exchange_rate",
        "fee", "net", "source", "status", "type", "reporting_category", "_fivetran_synced"],
}


def payment_views(regional: Mapping[str, Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    """The region-tagged payment tables, from ``{table: {region: frame}}``."""
    return all_regions(regional, PAYMENT_COLUMNS)


def condition_of(metadata: str | Column) -> Column:
    return json_scalar(metadata, "$.condition")


def intent_price_id(metadata: str | Column = "metadata") -> Column:
    """Price id noted on a payment intent, under either of its two keys."""
    return F.coalesce(json_scalar(metadata, "$.paymentIntentPriceId"), json_scalar(metadata, "$.stripePriceIds"))


def succeeded(t: Tables) -> DataFrame:
    return t["charge"].filter(F.col("status") == "succeeded")


def latest_subscriptions(t: Tables) -> DataFrame:
    """The newest version of every subscription."""
    newest = latest_per_key(t["subscription_history"], ["id"], ["valid_to"], tie_break=["valid_from", "latest_invoice_id"])
    return newest.select("region", F.col("id").alias("subscription_id"), "customer_id", "status",
                         F.to_date("created").alias("created_at"),
                         F.to_date(F.coalesce("ended_at", "valid_to")).alias("ended_at"))


def item_mrr(t: Tables, paid_quantity_only: bool = True) -> DataFrame:
    """Monthly recurring revenue per subscription item, with plan and product attributes."""
    items = t["subscription_item"]
    if paid_quantity_only:
        items = items.filter(F.col("quantity") > 0)
    plan = t["plan"].select(F.col("id").alias("plan_id"), "currency", "plan_interval", "interval_count", "product_id",
                            "amount", json_scalar("metadata", "$.boxes").alias("n_boxes"))
    product = t["product"].select(F.col("id").alias("product_id"), F.col("name").alias("product_name"),
                                  condition_of("metadata").alias("condition"))
    priced = with_rate(items.join(plan, "plan_id").join(product, "product_id", "left"), "currency", t["fx"],
                       subunits=t["subunits"])
    return priced.select(
        "subscription_id", "currency", "plan_id", "plan_interval", "interval_count", "product_id", "n_boxes",
        "product_name", F.coalesce("condition", F.lit("Other")).alias("condition"), "fx_to_usd",
        monthly_recurring("amount", "quantity", "plan_interval", "interval_count", "subunits").alias("mrr_local"))


def subscription_intervals(t: Tables, paid_only: bool = True, paid_quantity_only: bool = True) -> DataFrame:
    """One row per subscription item with its MRR and its [created_at, ended_at] interval."""
    slices = effective_end(latest_subscriptions(t), t["invoice"], t["charge"], paid_only)
    return (slices.join(item_mrr(t, paid_quantity_only), "subscription_id", "left")
                  .withColumn("mrr_local", F.coalesce("mrr_local", F.lit(0.0)))
                  .withColumn("mrr_usd", F.col("mrr_local") / F.col("fx_to_usd")).drop("fx_to_usd", "status"))


def _metric_rows(days: DataFrame, end: str = "ended_at") -> DataFrame:
    live = F.col(end) >= F.col("obs_date")
    return days.select(
        "region", "subscription_id", "customer_id", "obs_date", "created_at", "ended_at", "currency", "plan_id",
        "plan_interval", "interval_count", "product_id", "product_name", "n_boxes", "condition",
        F.when(live, F.col("mrr_local")).otherwise(F.lit(0.0)).alias("mrr_local"),
        F.when(live, F.col("mrr_usd")).otherwise(F.lit(0.0)).alias("mrr_usd"))


def subscription_metrics(t: Tables, as_of, start=CALENDAR_START, step: str = "day", show: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Subscription item x day with its MRR, plus one zero day after the end (hub of the lifecycle jobs). ``step='month'`` gives
    its first-of-month rows alone. ``show`` rounds and formats the columns of the intervals, once each and not once a day."""
    spans = subscription_intervals(t)
    if show is None:
        return _metric_rows(expand_intervals(spans, "created_at", "ended_at", "obs_date", start, as_of, step, tail_days=1))
    # the dates that are counted stay beside the dates that are shown
    spans = show(spans.withColumn("_days", F.struct("created_at", "ended_at")))
    days = expand_intervals(spans, "_days.created_at", "_days.ended_at", "obs_date", start, as_of, step, tail_days=1)
    return _metric_rows(days, "_days.ended_at").withColumn("obs_date", F.col("obs_date").cast("string"))


def _month_slices(spans: DataFrame, as_of, start) -> DataFrame:
    """The intervals with their zero day, cut at months: ``month`` and the days ``_from`` to ``_to`` in it."""
    first = F.greatest(F.col("created_at"), F.lit(start).cast("date"))
    last = F.least(F.date_add("ended_at", 1), F.lit(as_of).cast("date"))
    months = F.sequence(F.trunc(first, "MM").cast("date"), F.trunc(last, "MM").cast("date"), F.expr("interval 1 month"))
    given = F.col("created_at").isNotNull() & F.col("ended_at").isNotNull() & (first <= last)
    cut = spans.filter(given).withColumn("month", F.explode(months))
    return cut.withColumns({"_from": F.greatest(first, F.col("month")), "_to": F.least(last, F.last_day("month"))})


def refresh_subscription_metrics(t: Tables, hub: PartitionedTable, spans: PartitionedTable, as_of, previous_as_of=None, start=CALENDAR_START) -> DataFrame:
    """Bring the stored :func:`subscription_metrics` up to date and return the (region, month) that were written anew.

    ``hub`` is kept by region and month of ``obs_date``, ``spans`` holds the intervals it was made of, by region. Intervals that the sources now give
    otherwise touch the months they cover now and covered before; if ``as_of`` has moved since ``previous_as_of``, so does every interval from that month on.
    Only days of touched months are expanded and written. The hub is switched before the intervals, so a refresh that fails between the two is made
    good by the next one, which touches the same months again.
    """
    with Stages(hub.spark) as stages:
        new = stages.materialise(subscription_intervals(t).select(*spans.schema.names))
        old = spans.read()
        changed = stages.materialise(differing_rows(old, new, ["region"], ["subscription_id", "plan_id"]).select(*spans.schema.names))
        touched = _month_slices(changed, as_of, start)
        if previous_as_of is not None and str(previous_as_of) != str(as_of):
            later = max(str(previous_as_of), str(as_of))
            moved = _month_slices(new, later, start).filter(F.col("month") >= F.trunc(F.lit(min(str(previous_as_of), str(as_of))).cast("date"), "MM"))
            touched = _month_slices(changed, later, start).unionByName(moved)
        touched = materialise(touched.select("region", "month").distinct())
        if touched.isEmpty():
            return touched
        # region and month, not region alone, decide what is expanded
        slices = null_safe_join(_month_slices(new, as_of, start), touched.withColumn("_touched", F.lit(True)), ["region", "month"], "inner")
        days = slices.withColumn("obs_date", F.explode(F.sequence("_from", "_to")))
        hub.replace(_metric_rows(days).withColumn("month", F.trunc("obs_date", "MM").cast("date")), touched)
        regions = changed.select("region").distinct()
        spans.replace(null_safe_join(new, regions.withColumn("_touched", F.lit(True)), ["region"], "inner"), regions)
        return touched


def subscription_hub(spark: SparkSession, t: Tables, path: str) -> tuple[PartitionedTable, PartitionedTable]:
    """The stored tables of :func:`refresh_subscription_metrics` below ``path``: (hub, intervals)."""
    spans = subscription_intervals(t)
    rows = _metric_rows(spans.withColumn("obs_date", F.lit(None).cast("date"))).withColumn("month", F.col("obs_date"))
    return (PartitionedTable(spark, f"{path}/hub", rows.schema, ["region", "month"]), PartitionedTable(spark, f"{path}/spans", spans.schema, ["region"]))


def subscription_months(t: Tables, as_of, start=CALENDAR_START) -> DataFrame:
    """The month starts of :func:`subscription_metrics` with its zero days already moved to the next month.

    Enough for every monthly job (snapshots, lifecycle, churn, LTV) at a thirtieth of the rows.
    """
    months = month_observations(subscription_intervals(t), "created_at", "ended_at", "mrr_usd", start, as_of)
    return months.select("region", "subscription_id", "customer_id", "obs_date", "created_at", "currency", "product_id",
                         "product_name", "condition", "mrr_usd")


def valued_spans(spans: DataFrame, as_of, start=CALENDAR_START) -> DataFrame:
    """:func:`subscription_metrics` as spans of days: ``first`` to ``last`` with ``value``, the MRR in USD, and the zero day after the end by itself.

    ``spans`` are :func:`subscription_intervals`; every row of the daily hub is one day of one of these spans.
    """
    begin, end = F.greatest(F.col("created_at"), F.lit(start).cast("date")), F.lit(as_of).cast("date")
    tail = F.date_add("ended_at", 1)
    span = lambda a, b, value: F.struct(a.alias("first"), F.least(b, end).alias("last"), value.alias("value"))
    both = F.array(span(begin, F.col("ended_at"), F.col("mrr_usd")), span(F.greatest(begin, tail), tail, F.lit(0.0)))
    given = spans.filter("created_at is not null and ended_at is not null").withColumn("_span", F.explode(both))
    return given.select("region", "customer_id", "product_name", "condition", "created_at", "_span.*").filter("first <= last")


def customer_levels(spans: DataFrame) -> DataFrame:
    """Daily MRR per region and customer as stretches of days with one value, in millionths: ``from_day``, ``to_day``, ``micros``.

    ``spans`` are :func:`valued_spans`. A customer's stretches are cut alike in all regions, so two of them cover the same days or none in common.
    """
    by_region = stretches(spans, ["customer_id"], F.col("first"), F.col("last"), by=["region"], micros=F.sum(F.rint(F.col("value") * 1e6).cast("long")))
    return by_region.select("region", "customer_id", "from_day", "to_day", "micros")


def subscription_levels(t: Tables, as_of, start=CALENDAR_START, dims: Sequence[str] = ("region", "condition")) -> DataFrame:
    """Totals of :func:`subscription_metrics` per segment, as stretches of days with equal levels.

    ``n_items`` counts the items with a row on a day, ``n_live`` those without the zero day after the end, ``mrr_micros`` adds their MRR in millionths.
    Read from the intervals, two rows each, so the work does not grow with their length; :func:`sweep.by_day` lists the days.
    """
    spans = subscription_intervals(t).filter(F.col("created_at").isNotNull() & F.col("ended_at").isNotNull())
    first, last = F.greatest(F.col("created_at"), F.lit(start).cast("date")), F.lit(as_of).cast("date")
    micros = F.coalesce(F.rint(F.col("mrr_usd") * 1e6).cast("long"), F.lit(0))
    present = signed_events(spans, first, F.least(F.date_add("ended_at", 1), last), dims, {"n_items": F.lit(1).cast("long")})
    live = signed_events(spans, first, F.least(F.col("ended_at"), last), dims, {"n_live": F.lit(1).cast("long"), "mrr_micros": micros})
    # levels stand until the last day read
    return levels([present, live], dims, ["n_items", "n_live", "mrr_micros"], until=as_of)


def customer_metrics(t: Tables, as_of, start=CALENDAR_START) -> DataFrame:
    """Customer x product x day MRR; unpaid subscriptions count, no churn day."""
    spans = subscription_intervals(t, paid_only=False, paid_quantity_only=False).filter("created_at is not null and ended_at is not null")
    first, last = F.greatest(F.col("created_at"), F.lit(start).cast("date")), F.least(F.col("ended_at"), F.lit(as_of).cast("date"))
    # summed by stretch of days with the same intervals, so that days are neither moved nor aggregated; staged, as cuts and pieces both read them
    summed = stretches(materialise(spans), ["region", "customer_id", "product_id", "product_name", "condition"], first, last, mrr_usd=F.sum("mrr_usd"))
    return by_day(summed, start, as_of, "obs_date").select("region", "customer_id", "obs_date", "product_id", "product_name", "condition", "mrr_usd")


def charge_lines(t: Tables, charges: DataFrame | None = None, lines_how: str = "left", intents_how: str = "left"
                 ) -> DataFrame:
    """Successful charges with their invoice lines; the price comes from the line, else from the payment intent."""
    charges = succeeded(t) if charges is None else charges
    intents = t["payment_intent"].select(F.col("id").alias("payment_intent_id"), F.col("metadata").alias("pi_metadata"))
    lines = t["invoice_line_item"].select("invoice_id", F.col("subscription_id").alias("line_subscription_id"),
                                          F.col("price_id").alias("line_price_id"), F.col("quantity").alias("line_quantity"),
                                          F.col("amount").alias("line_amount"))
    joined = charges.join(intents, "payment_intent_id", intents_how).join(lines, "invoice_id", lines_how)
    return joined.withColumn("price_id", F.coalesce("line_price_id", intent_price_id("pi_metadata")))


def price_products(t: Tables, how: str = "left") -> DataFrame:
    """Prices with their product's name and condition."""
    product = t["product"].select(F.col("id").alias("product_id"), F.col("name").alias("product_name"),
                                  condition_of("metadata").alias("condition"), "active")
    price = t["price"].select(F.col("id").alias("price_id"), "product_id", "unit_amount", "recurring_interval",
                              "recurring_interval_count")
    return price.join(product, "product_id", how)


def purchase_type_of(subscription_id: str) -> Column:
    return F.when(F.col(subscription_id).isNull(), "One-Time").otherwise("Subscription")


def charge_history(t: Tables, as_of, start=CALENDAR_START) -> DataFrame:
    """Month x customer x product amounts in USD with zeros for silent months since the first purchase.

    A row per entity and month of the calendar is what the result is; the calendar from ``start`` to ``as_of`` bounds it.
    """
    charges = with_rate(succeeded(t), "currency", t["fx"], "inner", t["subunits"])
    # charges without a customer are one group, as in a window over the customer
    first = charges.groupBy("customer_id").agg(F.min(F.to_date("created")).alias("first_purchase"))
    lines = charge_lines(t, charges.select("id", "created", "region", "customer_id", "invoice_id", "payment_intent_id", "amount", "fx_to_usd", "subunits"))
    rows = lines.join(price_products(t), "price_id", "left").select(
        F.col("created"), "region", purchase_type_of("line_subscription_id").alias("purchase_type"), "customer_id",
        "product_id", "product_name", "condition",
        minor_to_usd(F.coalesce("unit_amount", "amount")).alias("amount")).distinct()
    # the customer's first purchase hangs on the customer alone; products of one name and condition are one row of the result
    entity = ["region", "purchase_type", "customer_id", "product_name", "condition"]
    months = rows.groupBy(*entity, month_start(F.to_date("created")).alias("created")).agg(F.sum("amount").alias("amount"))
    dated = null_safe_join(months, first, ["customer_id"])
    zero_from = F.greatest(month_start("first_purchase"), F.lit(start).cast("date"))
    filled = fill_months(dated, [*entity, "first_purchase"], "created", "amount", zero_from, F.lit(as_of).cast("date"))
    return filled.select("created", month_start("first_purchase").alias("first_purchase"), *entity, "amount")


def recent_payment_intents(t: Tables, as_of: Column, hours: int = 24) -> DataFrame:
    """Intents created in the last ``hours`` before ``as_of`` (a timestamp)."""
    recent = t["payment_intent"].filter(F.col("created") >= as_of - F.expr(f"interval {hours} hours"))
    return recent.select("region", F.col("id").alias("payment_intent_id"))


def customer_purchase_history(t: Tables) -> DataFrame:
    """Purchases per customer in date order with number and next date, sorted by customer and date."""
    invoices = (t["invoice"].filter(F.col("billing_reason").isin("subscription_create", "subscription_cycle"))
                .select("customer_id", F.to_date("created").alias("purchase_date"),
                        F.col("billing_reason").alias("kind")).distinct())
    single = (succeeded(t).filter("invoice_id is null")
              .select("customer_id", F.to_date("created").alias("purchase_date"), F.lit("one_time").alias("kind")).distinct())
    numbered = sequence_events(invoices.unionByName(single), "customer_id", "purchase_date", ["kind"],
                               "purchase_number", "next_purchase_date")
    shown = numbered.select("customer_id", "purchase_number", "purchase_date", "next_purchase_date")
    return shown.orderBy("customer_id", "purchase_date", "purchase_number")


def monthly_charges(t: Tables) -> DataFrame:
    """Charge lines of the card and the video-shop channel in one 18-column shape."""
    bt = t["balance_transaction"].select(F.col("id").alias("balance_transaction_id"), "type", "fee",
                                         F.col("amount").alias("bt_amount"))
    cogs = t["price_cogs"].select("price_id", "cogs", "cashback", "gst_vat")
    card = (with_rate(charge_lines(t, intents_how="inner").join(bt, "balance_transaction_id"), "currency", t["fx"], "inner",
                      t["subunits"])
            .join(price_products(t), "price_id", "left").join(cogs, "price_id", "left"))
    card = card.select(
        F.lit("Stripe").alias("sales_channel"), "region", "type", purchase_type_of("line_subscription_id").alias("purchase_type"),
        "customer_id", F.col("id").alias("charge_id"), F.to_date("created").alias("purchase_date"),
        minor_to_usd("amount").alias("total_charge_amount_usd"),
        F.coalesce(F.try_divide("amount_refunded", "amount"), F.lit(0.0)).alias("refund_rate"),
        "product_id", "product_name", "condition", F.coalesce("line_quantity", F.lit(1)).alias("quantity"),
        minor_to_usd("unit_amount").alias("line_item_amount_usd"),
        (F.col("cogs") / F.col("fx_to_usd")).alias("cogs"), "cashback", "gst_vat",
        F.coalesce(F.try_divide("fee", "bt_amount"), F.lit(0.0)).alias("fee_rate"))
    costs = t["tiktok_cogs"].select("sku_id", "product_name", F.col("cogs").alias("unit_cogs"))
    video = with_rate(t["tiktok_orders"].filter(F.col("revenue") > 0).join(costs, "sku_id", "left"), "currency", t["fx"])
    video = video.select(
        F.lit("TikTok").alias("sales_channel"), F.lit("sg").alias("region"), F.lit(None).cast("string").alias("type"),
        F.lit("One-Time").alias("purchase_type"), F.col("buyer_username").alias("customer_id"),
        F.col("order_id").cast("string").alias("charge_id"), F.col("created_time").alias("purchase_date"),
        F.lit(0.0).alias("total_charge_amount_usd"),
        (F.coalesce("order_refund_amount", F.lit(0.0)) / F.col("revenue")).alias("refund_rate"),
        F.col("sku_id").cast("string").alias("product_id"), "product_name", F.lit(None).cast("string").alias("condition"),
        "quantity", (F.col("revenue") / F.col("fx_to_usd")).alias("line_item_amount_usd"),
        (F.col("quantity") * F.col("unit_cogs") / F.col("fx_to_usd")).alias("cogs"), F.lit(0.0).alias("cashback"),
        F.lit(0.0).alias("gst_vat"),
        F.coalesce(F.col("payment_gateway_fee") / F.col("revenue"), F.lit(0.0)).alias("fee_rate"))
    return card.unionByName(video)


def non_subscription_charges(t: Tables) -> DataFrame:
    """Charges on invoices outside subscriptions, per product."""
    outside = (t["invoice"].filter(F.col("subscription_id").isNull() | (F.col("subscription_id") == ""))
               .select(F.col("id").alias("invoice_id")))
    lines = charge_lines(t, lines_how="inner", intents_how="inner").join(outside, "invoice_id")
    priced = with_rate(lines, "currency", t["fx"], "inner", t["subunits"]).join(price_products(t), "price_id", "left")
    usd = minor_to_usd("amount")
    return (priced.groupBy("region", "customer_id", F.col("id").alias("charge_id"), F.col("created").alias("charge_created"),
                           usd.alias("charge_amount_usd"), F.coalesce("product_name", F.lit("Unknown")).alias("product_name"),
                           "condition")
                  .agg(F.sum(minor_to_usd(F.coalesce("amount", "line_amount"))).alias("total_amount_usd")))


def one_time_upgrade_rate(t: Tables) -> DataFrame:
    """Share of one-time buyers who later bought through a subscription. One pass over the charges."""
    inv = t["invoice"].select(F.col("id").alias("invoice_id"), "subscription_id")
    day, member = F.to_date("created"), F.col("subscription_id").isNotNull()
    firsts = (succeeded(t).join(inv, "invoice_id", "left").groupBy("customer_id")
              .agg(F.min(F.when(~member, day)).alias("one_time"), F.min(F.when(member, day)).alias("member")))
    one_time = firsts.filter("one_time is not null").select("customer_id", F.col("one_time").alias("acq_date"))
    subscribers = firsts.filter("member is not null").select("customer_id", F.col("member").alias("acq_date"))
    return conversion_share(one_time, subscribers, "customer_id", "acq_date", flag="subscribed")


def price_by_payment(t: Tables, as_of: Column, hours: int = 24) -> DataFrame:
    """Price of every recent payment intent."""
    recent = t["payment_intent"].filter(F.col("created") >= as_of - F.expr(f"interval {hours} hours"))
    charges = t["charge"].select("payment_intent_id", "invoice_id")
    lines = t["invoice_line_item"].select("invoice_id", F.col("price_id").alias("line_price_id"))
    price = t["price"].select(F.col("id").alias("price_id"), "product_id", F.col("nickname").alias("price_nickname"),
                              json_scalar("metadata", "$.boxes").alias("n_boxes"))
    wanted = (recent.select("region", F.col("id").alias("payment_intent_id"), "metadata")
              .join(charges, "payment_intent_id", "left").join(lines, "invoice_id", "left")
              .withColumn("wanted", F.coalesce("line_price_id", intent_price_id())))
    return (wanted.join(price, F.col("wanted") == F.col("price_id"), "left")
                  .select("region", "payment_intent_id", "product_id", "price_id", "price_nickname", "n_boxes"))


def price_metadata_check(t: Tables) -> DataFrame:
    """Charges without invoice: what either price-id key of the intent resolves to, for teleconsult products."""
    named = (price_products(t).filter(F.col("active").eqNullSafe(True))
             .select("price_id", "product_name", "condition"))
    intent = t["payment_intent"].select(
        F.col("id").alias("payment_intent_id"), F.col("description").alias("payment_intent_description"),
        json_scalar("metadata", "$.paymentIntentPriceId").alias("key_a"), json_scalar("metadata", "$.stripePriceIds").alias("key_b"))
    rows = with_rate(succeeded(t).filter("invoice_id is null").join(intent, "payment_intent_id"), "currency", t["fx"],
                     subunits=t["subunits"])
    for key, suffix in (("key_a", "pi_price_id"), ("key_b", "pi_stripe_price_id")):
        side = named.select(F.col("price_id").alias(key), F.col("product_name").alias(f"product_from_{suffix}"),
                            F.col("condition").alias(f"condition_from_{suffix}"))
        rows = rows.join(side, key, "left")
    resolved = F.lower(F.coalesce("product_from_pi_price_id", "product_from_pi_stripe_price_id"))
    return rows.filter(resolved.startswith("tele")).select(
        F.to_date("created").alias("date"), "region", F.col("id").alias("charge_id"),
        F.col("description").alias("charge_description"), "payment_intent_id", "payment_intent_description",
        "product_from_pi_price_id", "condition_from_pi_price_id", "product_from_pi_stripe_price_id",
        "condition_from_pi_stripe_price_id", "currency", (F.col("amount") / F.col("subunits")).alias("charge_amount_local"))


def rx_vs_otc(t: Tables, not_rx: Sequence[str], otc: Sequence[str]) -> DataFrame:
    """Per region: share of prescription customers who also bought an over-the-counter product."""
    lines = t["invoice_line_item"].select("invoice_id", "price_id")
    owner = price_products(t, how="inner").select("price_id", "product_id")
    bought = (succeeded(t).select("region", "customer_id", "invoice_id")
              .join(t["invoice"].select(F.col("id").alias("invoice_id")), "invoice_id")
              .join(lines, "invoice_id").join(owner, "price_id"))
    kinds = (bought.groupBy("region", "customer_id")
             .agg(F.max((~F.col("product_id").isin(*not_rx)).cast("int")).alias("rx"),
                  F.max(F.col("product_id").isin(*otc).cast("int")).alias("otc")))
    rx = kinds.filter("rx = 1 and customer_id is not null").select("region", "customer_id")
    # the over-the-counter side matches by customer in any region, one match per region it bought in
    otc_regions = kinds.filter("otc = 1").groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    counts = (rx.join(otc_regions, "customer_id", "left")
                .groupBy("region", F.col("n").isNotNull().alias("has_otc"))
                .agg(F.sum(F.coalesce("n", F.lit(1))).alias("n_customers")))
    return share_of_groups(counts, "n_customers", ["region"], "share_of_region", 2).orderBy("region", F.col("has_otc").desc())


def purchase_export(t: Tables, since: str) -> DataFrame:
    """Charge rows with a pseudonymous id of the customer row found, product, both price-id sources and the price metadata map."""
    meta = t["intent_metadata"]
    price_keys = meta.groupBy(F.col("payment_intent_id").alias("pi_id")).agg(
        F.max(F.when(F.col("key") == "paymentIntentPriceId", F.col("value"))).alias("a"),
        F.max(F.when(F.col("key") == "stripePriceIds", F.col("value"))).alias("b"))
    invoice_price = (t["invoice_line_item"].groupBy(F.col("invoice_id").alias("inv_id"))
                     .agg(F.max("price_id").alias("invoice_price_id")))
    price_map = map_of_entries(t["price_metadata"], ["price_id"], "key", "value", "price_metadata")
    sub_price = t["subscription_price"].select(F.col("subscription_id").alias("sub_id"), "price_id")
    price = t["price"].select(F.col("id").alias("price_id"), F.col("product_id").alias("prod_id"))
    product = t["product"].select(F.col("id").alias("prod_id"), F.col("name").alias("product_name"))
    customers = t["customer"].select(F.col("id").alias("customer_id"), F.col("id").alias("found_id"), "email")
    refunds = t["refund"].select(F.col("charge_id"), F.col("amount").alias("refund_amount")).distinct()
    return (succeeded(t).filter(F.col("created") >= F.lit(since).cast("date"))
            .join(customers, "customer_id", "left")
            .join(t["invoice"].select(F.col("id").alias("invoice_id"), "subscription_id"), "invoice_id", "left")
            .join(sub_price, F.col("subscription_id") == F.col("sub_id"), "left").join(price, "price_id", "left")
            .join(product, "prod_id", "left").join(price_map, "price_id", "left")
            .join(invoice_price, F.col("invoice_id") == F.col("inv_id"), "left")
            .join(price_keys, F.col("payment_intent_id") == F.col("pi_id"), "left")
            .join(refunds, F.col("id") == F.col("charge_id"), "left")
            .select(F.md5(F.trim("found_id")).alias("id"), "email", F.col("created").alias("purchase_date"),
                    F.col("description").alias("transaction_type"), F.col("amount").alias("purchase_amount"), "refund_amount",
                    "product_name", "price_id", F.coalesce("a", "b").alias("price_id_no_invoice"), "invoice_price_id",
                    "price_metadata"))


def interval_changes(t: Tables, low: int = 3, within_days: int = 90) -> DataFrame:
    """Subscriptions on a short billing interval and their moves to a longer one within 90 days."""
    plans = (t["plan"].filter(F.col("plan_interval") == "month")
             .select(F.col("id").alias("plan_id"), "product_id", "interval_count"))
    product = t["product"].select(F.col("id").alias("product_id"), F.col("name").alias("product_name"),
                                  condition_of("metadata").alias("condition"))
    lines = t["invoice_line_item"].select(F.col("invoice_id").alias("latest_invoice_id"), "plan_id")
    versions = (t["subscription_history"].join(lines, "latest_invoice_id").join(plans, "plan_id").join(product, "product_id")
                .select(F.upper("region").alias("country"), F.col("id").alias("subscription_id"), "status",
                        "created", "valid_from", "plan_id", "product_id", "product_name", "condition", "interval_count").distinct())
    keys = ["subscription_id", "product_id"]
    # the history is read for its neighbours, its firsts, the starts and the rises: computed once. Versions of one day stay apart.
    history = attribute_history(materialise(versions), keys, ["valid_from", "plan_id"], "interval_count")
    rises = detect_increase(history, keys, "interval_count", "valid_from", "created", low, within_days, F.col("status") == "active",
                            tie_break=["plan_id"])
    return rises.select("country", "subscription_id", F.to_date("created").alias("subscription_created"),
                        F.to_date("valid_from").alias("subscription_updated"), "product_id", "product_name", "condition", "first_interval_count", "current_interval_count", "days_elapsed")


def contact_export(t: Tables) -> DataFrame:
    """Customers with a successful charge or an active subscription, and their last transaction."""
    newest = latest_per_key(t["subscription_history"], ["id"], ["created"], tie_break=["valid_to", "latest_invoice_id"])
    active = newest.filter(F.col("status") == "active").select(F.col("customer_id").alias("act_id")).distinct()
    last = succeeded(t).groupBy(F.col("customer_id").alias("ch_id")).agg(F.max("created").alias("last_transaction_date"))
    return (t["customer"].join(last, F.col("id") == F.col("ch_id"), "left")
            .join(active, F.col("id") == F.col("act_id"), "left")
            .filter("act_id is not null or ch_id is not null")
            .select("region", F.col("id").alias("customer_id"), "name", "email", "phone",
                    F.col("act_id").isNotNull().alias("is_active_subscriber"), "last_transaction_date"))


def contact_rows(contacts: DataFrame) -> DataFrame:
    """The export's column names and epoch seconds."""
    return contacts.select(F.col("region").alias("Region"), "name", "email", "phone",
                           F.col("customer_id").alias("Stripe Customer ID"),
                           F.col("is_active_subscriber").alias("Is Active Subscriber"),
                           F.unix_timestamp(F.col("last_transaction_date").cast("timestamp")).alias("Last Transaction Date"))


def metadata_worklist(t: Tables, names: DataFrame) -> DataFrame:
    """Products without a condition that the (product_name, condition) sheet can fill."""
    wanted = names.select("product_name", "condition").distinct()
    lacking = t["product"].filter(condition_of("metadata").isNull()).select("id", "name", F.col("region").alias("country"))
    return lacking.join(wanted, F.col("name") == F.col("product_name")).select("id", "name", "country", "condition")

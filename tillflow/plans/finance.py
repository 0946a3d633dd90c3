"""Finance jobs: cost ranges, the order-line hub over all sales channels, contribution margin and P&L."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import greatest_strict, json_scalar, month_start, safe_divide
from ..operators.distinct import count_distinct_by
from ..operators.joins import null_safe_join, with_group_value
from ..operators.lifecycle import new_or_existing
from ..operators.margin import margin_waterfall, negative_part, pivot_txn, positive_part, tax_included
from ..operators.money import minor_to_usd, with_rate
from ..operators.ranges import asof_range_join, effective_ranges
from ..operators.sequence import activity_within, cumulative_by
from ..sources.writers import Stages, in_slice, is_table, materialise, materialise_parts, slices_of
from .payments import condition_of, intent_price_id, price_products, purchase_type_of, succeeded

Tables = Mapping[str, DataFrame]

# Cashback share of products sold through the shop.
CASHBACK = 0.02

# The order-line schema every sales channel is brought to.
SALES_COLUMNS = {
    "sales_channel": "string", "region": "string", "type": "string", "purchase_type": "string", "billing_reason": "string",
    "brand": "string", "customer_id": "string", "email": "string", "charge_id": "string", "order_sys_id": "string",
    "payment_intent_id": "string", "subscription_id": "string", "recurring_interval": "string",
    "recurring_interval_count": "long", "purchase_date": "date", "total_charge_amount_usd": "double",
    "refund_rate": "double", "amount_refunded_usd": "double", "product_id": "string", "product_name": "string",
    "price_id": "string", "condition": "string", "quantity": "long", "currency": "string",
    "line_item_amount_usd": "double", "cogs": "double", "cashback": "double", "gst_vat": "double", "fee_rate": "double",
    "packaging": "double", "acquisition_date": "date",
}


# --- effective-dated reference data -------------------------------------------------------------------------------
def tax_rate_history(t: Tables, closed: bool = True) -> DataFrame:
    return effective_ranges(t["tax_rates"], ["region"], "effective_from", closed).select(
        "region", "from_date", "to_date", "rate")


def product_cost_per_box(sheets: DataFrame, closed: bool = True) -> DataFrame:
    """Box cost ranges of a region-tagged cost sheet; separate regional sheets are first put through ``region_union``."""
    rows = sheets.select("region", F.col("id").alias("product_id"), "cost_box", "packaging_cost", "effective_date")
    return effective_ranges(rows, ["region", "product_id"], "effective_date", closed)


def product_cost(t: Tables, boxes: DataFrame) -> DataFrame:
    """Price-level cost: box cost times the price's number of boxes (default 1)."""
    price = t["price"].select("region", "product_id", F.col("id").alias("price_id"), "currency",
                              F.coalesce(json_scalar("metadata", "$.boxes").cast("double"), F.lit(1.0)).alias("n"))
    joined = boxes.withColumnRenamed("region", "_region").join(
        price.withColumnRenamed("product_id", "_pid"),
        (F.col("product_id") == F.col("_pid")) & (F.col("_region") == F.col("region")), "left")
    return joined.select("region", "product_id", "price_id", "from_date", "to_date", "currency",
                         (F.col("cost_box") * F.coalesce("n", F.lit(1.0))).alias("cogs"),
                         F.col("packaging_cost").alias("packaging"), F.lit(CASHBACK).alias("cashback"))


def marketplace_costs(t: Tables, closed: bool = True) -> dict[str, DataFrame]:
    """Cost ranges of the three marketplaces."""
    return {"lazada": effective_ranges(t["lazada_cogs"], ["seller_sku"], "effective_date", closed),
            "shopee": effective_ranges(t["shopee_cogs"], ["sku_reference_no_", "product_id"], "effective_date", closed),
            "tiktok": effective_ranges(t["tiktok_costs"], ["sku_id"], "effective_date", closed)}


def cod_sg_orders(t: Tables) -> DataFrame:
    """Cash-on-delivery orders of the first region, old and new sheet."""
    old = t["cod_sg_old"].select(F.col("purchase_date").alias("date"), "email", F.lower("currency").alias("currency"),
                                 "quantity", "product_id", "purchase_amount")
    new = t["cod_sg_new"].select("date", "email", F.lower("currency").alias("currency"), "quantity", "product_id",
                                 F.col("revenue").alias("purchase_amount"))
    return old.unionByName(new)


def cod_hk_orders(t: Tables) -> DataFrame:
    """Cash-on-delivery orders of the second region: old sheet, then airway bills with their lines."""
    old = t["cod_hk_old"].select(F.col("purchase_date").alias("date"), "email", F.lower("currency").alias("currency"),
                                 "quantity", "product_id", "purchase_amount")
    skus = t["product_cost"].filter(F.col("region") == "hk").select(F.lower("sku").alias("_sku"), F.col("id").alias("product_id")).distinct()
    # the bills first: of all lines only theirs move on to the skus
    lines = t["airway_bills"].join(t["airway_lines"], "awb_no", "left")
    new = lines.join(skus, F.lower("sku") == F.col("_sku"), "left").select(
        F.col("delivery_date").alias("date"), "email", F.lit("hkd").alias("currency"), "quantity", "product_id",
        F.col("revenue").alias("purchase_amount"))
    return old.unionByName(new)


# --- order-line hub ---------------------------------------------------------------------------------------------------
def _conform(df: DataFrame, **values: Column | str) -> DataFrame:
    """Project a channel onto the order-line schema; columns without a value are typed NULLs. The start of the subscription follows where a value is given."""
    kinds = SALES_COLUMNS | {c: "date" for c in values if c == "subscription_created_date"}
    return df.select(*[(F.col(v) if isinstance(v, str) else v if v is not None else F.lit(None)).cast(kind).alias(c)
                       for c, kind in kinds.items() for v in [values.get(c)]])


def normalize_sales(channels: Sequence[DataFrame]) -> DataFrame:
    """Stack conformed channels."""
    return reduce(DataFrame.unionByName, channels)


def stripe_charges(t: Tables, priced: DataFrame, unused: Sequence[str] = (), owned: Stages | None = None) -> DataFrame:
    """Succeeded card charges with their teleconsultation, rate, customer and first date, one row each.

    The one-to-one joins come first; what hangs on an intent or a customer meets there, so a charge moves once for each. The joined charges
    are staged, because the first dates and the charges both read them; ``owned`` stages them after every join, so that the shuffle files of
    one join at a time are on disk. ``unused`` columns become NULL.
    """
    step = (lambda df: df) if owned is None else owned.materialise
    tele = (priced.filter(F.lower("product_name").contains("tele"))
            .select(F.col("price_id").alias("tel_price"), F.col("product_id").alias("tel_product"),
                    F.col("product_name").alias("tel_name"), F.col("condition").alias("tel_condition")))
    intent = t["payment_intent"].select(F.col("id").alias("payment_intent_id"), intent_price_id().alias("intent_price"))
    intent = intent.join(tele, F.col("intent_price") == F.col("tel_price"), "left").drop("intent_price")
    bt = t["balance_transaction"].select(F.col("id").alias("balance_transaction_id"), "type", "fee",
                                         F.col("amount").alias("bt_amount"))
    none = {c: F.lit(None).cast("string") for c in unused}
    charges = (succeeded(t).select("region", "customer_id", F.col("id").alias("charge_id"),
                                   json_scalar("metadata", "$.orderId").alias("order_sys_id"), "payment_intent_id",
                                   "balance_transaction_id", "invoice_id", F.to_date("created").alias("purchase_date"), "amount",
                                   "amount_refunded", "currency")
               .withColumns({c: none[c] for c in none if c == "order_sys_id"}))
    meant = step(charges.join(intent, "payment_intent_id").withColumns({c: none[c] for c in none if c == "payment_intent_id"}))
    charges = with_rate(meant.join(bt, "balance_transaction_id").drop("balance_transaction_id"), "currency", t["fx"], "inner", t["subunits"])
    charges = materialise(charges) if owned is None else owned.materialise(charges)

    if owned is not None:
        owned.drop(meant)

    first = charges.groupBy("customer_id").agg(F.min("purchase_date").alias("acquisition_date"))
    customer = t["customer"].select(F.col("id").alias("customer_id"), "email").withColumns({c: none[c] for c in none if c == "email"})
    # one brand per customer, so lines do not repeat
    brand = t["patient"].groupBy(F.col("stripe_customer_id").alias("customer_id")).agg(F.min("from_platform_env").alias("brand"))
    people = first.join(customer, "customer_id", "left").join(brand, "customer_id", "left")
    known = step(null_safe_join(charges, people, ["customer_id"]))
    if owned is not None:
        owned.drop(charges)
    return known


def stripe_parts(t: Tables, cost: DataFrame, priced: DataFrame | None = None, starts: DataFrame | None = None, unused: Sequence[str] = (),
                 n: int = 1, owned: Stages | None = None) -> Iterator[DataFrame]:
    """Card charges by invoice line, as ``n`` frames by slices of the invoices.

    What hangs on an invoice is joined to those charges, so the wide lines move once, by their price. ``owned`` stages the charges join by join and
    what every slice reads.
    """
    staged = (lambda df: df) if owned is None else owned.materialise
    priced = price_products(t) if priced is None else priced
    charges = stripe_charges(t, priced, unused, owned)
    invoice = t["invoice"].select(F.col("id").alias("invoice_id"), "subscription_id", "billing_reason", "subtotal")
    line = t["invoice_line_item"].select("invoice_id", F.col("subscription_id").alias("line_subscription_id"),
                                         F.col("price_id").alias("line_price"), "quantity", F.col("amount").alias("line_amount"))
    sold = priced.select(F.col("price_id").alias("px_price"), F.col("product_id").alias("px_product"),
                                    F.col("product_name").alias("px_name"), F.col("condition").alias("px_condition"),
                                    "recurring_interval", "recurring_interval_count")
    price_cost = staged(cost.select("price_id", "from_date", "to_date", "cogs", "packaging", "cashback"))
    base = F.when(F.col("subtotal") > 0, F.col("subtotal")).otherwise(F.col("amount"))
    invoice_id = F.col("invoice_id").cast("string")
    for k in range(n):
        # charges without an invoice have no lines, whatever their slice
        own, billed = charges.filter(in_slice(k, n, F.coalesce(invoice_id, F.col("charge_id").cast("string")))), invoice.filter(in_slice(k, n, invoice_id))
        if starts is not None:
            billed = billed.join(starts, "subscription_id", "left")
        lines = (own.join(billed, "invoice_id", "left").join(line.filter(in_slice(k, n, invoice_id)), "invoice_id", "left")
                 .join(sold, F.col("line_price") == F.col("px_price"), "left"))
        # every price with a cost is one of ``sold``: by the line's price, so that the lines stay where the join before put them
        lines = asof_range_join(lines, price_cost, {"price_id": "line_price"}, "purchase_date")
        yield _conform(
            lines, sales_channel=F.lit("Stripe"), region="region", type="type",
            purchase_type=purchase_type_of("line_subscription_id"),
            billing_reason=F.coalesce("billing_reason", F.lit("manual")), brand="brand", customer_id="customer_id",
            email="email", charge_id="charge_id", order_sys_id="order_sys_id", payment_intent_id="payment_intent_id",
            subscription_id="subscription_id", recurring_interval="recurring_interval",
            recurring_interval_count="recurring_interval_count", purchase_date="purchase_date",
            total_charge_amount_usd=minor_to_usd("amount"),
            refund_rate=F.coalesce(safe_divide("amount_refunded", "amount"), F.lit(0.0)),
            amount_refunded_usd=minor_to_usd("amount_refunded"), product_id=F.coalesce("px_product", "tel_product"),
            product_name=F.coalesce("px_name", "tel_name"), price_id=F.coalesce("px_price", "tel_price"),
            condition=F.coalesce("px_condition", "tel_condition"), quantity=F.coalesce("quantity", F.lit(1)), currency="currency",
            line_item_amount_usd=minor_to_usd(safe_divide("amount", base) * F.col("line_amount")),
            cogs=F.col("cogs") / F.col("fx_to_usd"), cashback="cashback",
            fee_rate=F.coalesce(safe_divide("fee", "bt_amount"), F.lit(0.0)),
            packaging=F.col("packaging") / F.col("fx_to_usd"), acquisition_date="acquisition_date",
            **({} if starts is None else {"subscription_created_date": "subscription_created_date"}))


def unread(columns: Sequence[str] | None) -> list[str]:
    """Of the columns that hang on a charge alone, those that are not among ``columns``."""
    return [c for c in ("email", "order_sys_id", "payment_intent_id") if columns is not None and c not in columns]


def line_slices(t: Tables) -> int:
    """In how many slices the order lines are made, by the size of the largest tables."""
    return slices_of(t["charge"], t["invoice_line_item"])


def stripe_sales(t: Tables, cost: DataFrame, priced: DataFrame | None = None, starts: DataFrame | None = None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Card charges by invoice line. ``priced`` is a staged :func:`price_products`, for jobs that read it several times; ``starts``
    (:func:`subscription_starts`) adds the start of the subscription; ``columns`` picks some. Large tables are worked in slices and staged."""
    n = line_slices(t)
    if n == 1:
        return next(stripe_parts(t, cost, priced, starts)).select(*(columns or ["*"]))
    spark, unused = cost.sparkSession, unread(columns)
    with Stages(spark) as owned:
        priced = owned.materialise(price_products(t)) if priced is None else priced
        return materialise_parts(spark, (part.select(*(columns or ["*"])) for part in stripe_parts(t, cost, priced, starts, unused, n, owned)))


def subscription_starts(t: Tables) -> DataFrame:
    return t["subscription_history"].select(F.col("id").alias("subscription_id"), F.to_date("created").alias("subscription_created_date")).distinct()


def tiktok_sales(t: Tables, costs: DataFrame) -> DataFrame:
    rows = with_group_value(t["tiktok_orders"], ["buyer_username"], acquisition_date=F.min("created_time"))
    rows = asof_range_join(rows, costs.select("sku_id", "product_name", "cogs", "packaging", "from_date", "to_date"),
                           {"sku_id": "sku_id"}, "created_time")
    rows = with_rate(rows, "currency", t["fx"])
    fx, net = F.col("fx_to_usd"), F.coalesce("sku_subtotal_after_discount", F.lit(1.0))
    refund = F.coalesce("order_refund_amount", F.lit(0.0))
    return _conform(
        rows, sales_channel=F.lit("TikTok"), region=F.lit("sg"), purchase_type=F.lit("One-Time"), billing_reason=F.lit("manual"),
        brand=F.lit("N/A"), customer_id="buyer_username", charge_id="order_id", purchase_date="created_time",
        total_charge_amount_usd=F.lit(0.0), refund_rate=safe_divide(refund, net), amount_refunded_usd=refund / fx,
        product_id="sku_id", product_name="product_name", quantity="quantity", currency=F.lower("currency"),
        line_item_amount_usd=F.col("sku_subtotal_after_discount") / fx, cogs=F.col("cogs") / fx, cashback=F.lit(0.0), fee_rate=-F.coalesce(safe_divide("payment_gateway_fee", net), F.lit(0.0)),
        packaging=F.col("packaging") / fx, acquisition_date="acquisition_date")


# Transaction types that are fees.
LAZADA_FEES = ["Orders-Lazada Fees", "Orders-Logistics", "Orders-Marketing Fees", "Other Services-Marketing Fees"]


def lazada_sales(t: Tables, costs: DataFrame) -> DataFrame:
    """Typed transactions summed per day and SKU; days without sales are dropped."""
    rows = with_rate(t["lazada_orders"], "currency", t["fx"])
    rows = asof_range_join(rows, costs.select("seller_sku", "product_name", "cogs", "packaging", "from_date", "to_date"),
                           {"seller_sku": "seller_sku"}, "transaction_date")
    fx, kind = F.col("fx_to_usd"), F.col("transaction_type")
    daily = pivot_txn(
        rows.select("transaction_date", "product_name", "seller_sku", (F.col("cogs") / fx).alias("cogs"),
                    (F.col("packaging") / fx).alias("packaging"), F.lower("currency").alias("currency"), "transaction_type",
                    (F.col("amount") / fx).alias("usd")),
        ["transaction_date", "product_name", "seller_sku", "cogs", "packaging", "currency"], F.col("usd"),
        {"sales": (kind == "Orders-Sales", 1), "refunds": (kind.startswith("Refunds"), -1), "fees": (kind.isin(LAZADA_FEES), -1)})
    daily = daily.filter(F.col("sales") > 0)
    return _conform(
        daily, sales_channel=F.lit("Lazada"), region=F.lit("sg"), purchase_type=F.lit("One-Time"), billing_reason=F.lit("manual"),
        brand=F.lit("N/A"), purchase_date="transaction_date", total_charge_amount_usd=F.lit(0.0),
        refund_rate=F.col("refunds") / F.col("sales"), amount_refunded_usd="refunds", product_id="seller_sku",
        product_name="product_name", quantity=F.lit(1), currency="currency", line_item_amount_usd="sales", cogs="cogs",
        cashback=F.lit(0.0), fee_rate=F.col("fees") / F.col("sales"), packaging="packaging")


def shopee_sales(t: Tables, costs: DataFrame) -> DataFrame:
    orders = t["shopee_orders"].withColumn("day", F.to_date("payout_completed_date"))
    rows = with_group_value(orders, ["username_buyer_"], acquisition_date=F.min("day"))
    rows = with_rate(rows, "currency", t["fx"]).join(t["shopee_quantities"], "order_id", "left")
    rows = asof_range_join(rows, costs.select("product_id", "sku_reference_no_", "condition", "cogs", "packaging", "from_date", "to_date"),
                           {"product_id": "product_id", "sku_reference_no_": "sku_reference_no_"}, "day")
    kinds = t["condition_type"].select("condition", F.col("purchase_type").alias("_type"), F.col("billing_reason").alias("_reason"))
    rows = rows.join(kinds, "condition", "left")
    fx, base = F.col("fx_to_usd"), greatest_strict("product_price", F.lit(1.0))
    fees = F.col("commission_fee") + F.col("service_fee") + F.col("transaction_fee") + F.col("ams_fee")
    return _conform(
        rows, sales_channel=F.lit("Shopee"), region=F.lit("sg"), purchase_type=F.coalesce("_type", F.lit("One-Time")),
        billing_reason=F.coalesce("_reason", F.lit("manual")), brand=F.lit("N/A"), customer_id="username_buyer_",
        purchase_date="day", total_charge_amount_usd=F.lit(0.0), refund_rate=F.col("refund_amount") / base,
        amount_refunded_usd=F.col("refund_amount") / fx, product_id="product_id", product_name="product_name",
        condition="condition", quantity=F.coalesce("quantity", F.lit(1)), currency=F.lower("currency"),
        line_item_amount_usd=F.col("product_price") / fx, cogs=F.col("cogs") / fx, cashback=F.lit(0.0),
        fee_rate=-fees / base, packaging=F.col("packaging") / fx, acquisition_date="acquisition_date")


def cod_sales(t: Tables, boxes: DataFrame, orders: DataFrame, region: str) -> DataFrame:
    """Cash-on-delivery orders of one region."""
    rows = with_rate(with_group_value(orders, ["email"], acquisition_date=F.min("date")), "currency", t["fx"])
    box = boxes.filter(F.col("region") == region).select("product_id", "cost_box", "packaging_cost", "from_date", "to_date")
    rows = asof_range_join(rows, box, {"product_id": "product_id"}, "date")
    product = t["product"].select(F.col("id").alias("product_id"), F.col("name").alias("product_name"),
                                  condition_of("metadata").alias("condition"))
    kinds = t["condition_type"].select("condition", F.col("purchase_type").alias("_type"), F.col("billing_reason").alias("_reason"))
    rows = rows.join(product, "product_id", "left").join(kinds, "condition", "left")
    fx = F.col("fx_to_usd")
    return _conform(
        rows, sales_channel=F.lit(f"{region.upper()} COD"), region=F.lit(region), purchase_type=F.coalesce("_type", F.lit("One-Time")),
        billing_reason=F.coalesce("_reason", F.lit("manual")), brand=F.lit("N/A"), customer_id="email", email="email",
        purchase_date="date", total_charge_amount_usd=F.col("purchase_amount") / fx, refund_rate=F.lit(0.0),
        amount_refunded_usd=F.lit(0.0), product_id="product_id", product_name="product_name", condition="condition",
        quantity="quantity", currency="currency", line_item_amount_usd=F.col("purchase_amount") / fx,
        cogs=F.col("cost_box") / fx, cashback=F.lit(CASHBACK), fee_rate=F.lit(0.0),
        packaging=F.col("packaging_cost") / fx, acquisition_date="acquisition_date")


def atome_sales(t: Tables, tax: DataFrame, cost: DataFrame, priced: DataFrame | None = None, starts: DataFrame | None = None,
                stage: Callable[[DataFrame], DataFrame] = materialise) -> DataFrame:
    """Instalment orders: signed transactions summed per order; orders without a positive amount are dropped."""
    # per order first: the sums and the order date shrink the sheet to one row per order, currency and tax rate
    txn = asof_range_join(with_rate(t["atome_manual"], "currency", t["fx"]), tax.withColumnRenamed("rate", "gst_vat"),
                          {"region": F.lit("sg")}, "transaction_time", by_year=True)
    fx = F.col("fx_to_usd")
    sums = (txn.groupBy("atome_order_id", "short_id", F.lower("currency").alias("currency"), "fx_to_usd", "gst_vat")
            .agg(F.min("transaction_time").alias("_first"), F.sum(positive_part("transaction_amount")).alias("sale"),
                 F.sum(negative_part("transaction_amount")).alias("refund"),
                 F.sum(F.col("sponsored_voucher_amount") + F.col("mdr_fee") + F.col("flat_fee")).alias("fees")))
    sums = with_group_value(stage(sums), ["atome_order_id"], order_date=F.min("_first")).filter(F.col("sale") > 0)
    order = t["app_order"].filter(F.col("region") == "sg").select(
        "short_id", "sys_id", "patient_id", "stripe_subscription_id", "stripe_payment_intent_id",
        F.coalesce("prescription_price_id", "price_id").alias("wanted"))
    if starts is not None:
        order = order.join(starts.withColumnRenamed("subscription_id", "stripe_subscription_id"), "stripe_subscription_id", "left")
    patient = t["patient"].select(F.col("sys_id").alias("patient_id"), "email", F.col("from_platform_env").alias("brand"))
    priced = price_products(t) if priced is None else priced
    sold = priced.select(F.col("price_id").alias("px"), "product_id", "product_name", "condition")
    price_cost = cost.select("price_id", "from_date", "to_date", "cogs", "packaging", "cashback")
    rows = with_group_value(sums.join(order, "short_id", "left"), ["patient_id"], acquisition_date=F.min("order_date"))
    rows = rows.join(patient, "patient_id", "left").join(sold, F.col("wanted") == F.col("px"), "left")
    rows = asof_range_join(rows, price_cost, {"price_id": "wanted"}, "order_date")
    return _conform(
        rows, sales_channel=F.lit("Atome"), region=F.lit("sg"),
        purchase_type=purchase_type_of("stripe_subscription_id"), billing_reason=F.lit("manual"), brand="brand",
        customer_id="patient_id", email="email", charge_id="atome_order_id", order_sys_id="sys_id",
        payment_intent_id="stripe_payment_intent_id", subscription_id="stripe_subscription_id", purchase_date="order_date",
        total_charge_amount_usd=F.col("sale") / fx, refund_rate=F.col("refund") / F.col("sale"),
        amount_refunded_usd=F.col("refund") / fx, product_id="product_id", product_name="product_name", price_id="wanted",
        condition="condition", quantity=F.lit(1), currency="currency", line_item_amount_usd=F.col("sale") / fx,
        cogs=F.col("cogs") / fx, cashback="cashback", gst_vat="gst_vat", fee_rate=-F.col("fees") / F.col("sale"),
        packaging="packaging", acquisition_date="acquisition_date",
        **({} if starts is None else {"subscription_created_date": "subscription_created_date"}))


def channel_sales(t: Tables, tax: DataFrame, cost: DataFrame, boxes: DataFrame, priced: DataFrame, starts: DataFrame,
                  stage: Callable[[DataFrame], DataFrame] = materialise) -> Iterator[DataFrame]:
    """The lines of every channel but the cards, one channel after the other."""
    market, none = marketplace_costs(t), F.lit(None).cast("date")
    yield tiktok_sales(t, market["tiktok"]).withColumn("subscription_created_date", none)
    yield shopee_sales(t, market["shopee"]).withColumn("subscription_created_date", none)
    yield cod_sales(t, boxes, cod_sg_orders(t), "sg").withColumn("subscription_created_date", none)
    yield cod_sales(t, boxes, cod_hk_orders(t), "hk").withColumn("subscription_created_date", none)
    yield lazada_sales(t, market["lazada"]).withColumn("subscription_created_date", none)
    yield atome_sales(t, tax, cost, priced, starts, stage)


def contribution_margin(t: Tables, columns: Sequence[str] | None = None) -> DataFrame:
    """Order lines of the seven sales channels with new/existing flag and subscription start (hub); ``columns`` picks some.

    Every channel but the cards is staged by itself: one plan of all channels is planned anew after each of its many stages, and their
    tables are broadcast at once, which is more than a driver holds. The cards' wide lines are left to be written once; of large tables they
    are worked in slices, and all lines go into one staged folder part by part.
    """
    tax, boxes = tax_rate_history(t), product_cost_per_box(t["product_cost"])
    cost, n = product_cost(t, boxes), line_slices(t)
    first = ["subscription_id", *[c for c in SALES_COLUMNS if c != "subscription_id"]]
    columns = list(columns or [*first, "new_existing", "subscription_created_date"])

    def finished(lines: DataFrame) -> DataFrame:
        # one tax lookup for all channels; instalment orders bring the rate of their transaction date
        lines = asof_range_join(lines, tax, {"region": "region"}, "purchase_date")
        lines = lines.withColumn("gst_vat", F.when(F.col("sales_channel") == "Atome", F.col("gst_vat")).otherwise(F.col("rate")))
        return lines.withColumn("new_existing", new_or_existing("purchase_date", "acquisition_date")).select(*columns)

    # cards, teleconsultations and instalments read the same prices with their JSON fields; only two channels know subscriptions, and
    # know their start before their lines fan out
    if n == 1:
        priced, starts = materialise(price_products(t)), subscription_starts(t)
        cards = next(stripe_parts(t, cost, priced, starts))
        return finished(normalize_sales([cards, *[materialise(df) for df in channel_sales(t, tax, cost, boxes, priced, starts)]]))
    spark, unused = cost.sparkSession, unread(columns)
    with Stages(spark) as owned:
        priced, starts = owned.materialise(price_products(t)), owned.materialise(subscription_starts(t))

        def parts() -> Iterator[DataFrame]:
            yield from map(finished, channel_sales(t, tax, cost, boxes, priced, starts, owned.materialise))
            yield from map(finished, stripe_parts(t, cost, priced, starts, unused, n, owned))
        return materialise_parts(spark, parts())


def sale_amount() -> Column:
    return F.coalesce("line_item_amount_usd", "total_charge_amount_usd")


# --- monthly hubs ---------------------------------------------------------------------------------------------------------
def delivery_costs(t: Tables) -> DataFrame:
    rows = with_rate(t["delivery_cost"], "currency", t["fx"], "inner")
    return (rows.groupBy(month_start("date").alias("date"), F.lower("country").alias("country"))
                .agg(F.sum(F.col("cost") / F.col("fx_to_usd")).alias("delivery")))


def opex(t: Tables) -> DataFrame:
    """Monthly operating cost pools per country; the sheet holds negative amounts."""
    rows = with_rate(t["opex"].filter("date is not null"), "currency", t["fx"], "inner")
    lines = ["teleconsultation_fees", "dispensing_fees", "operating_expense", "staff_cost"]
    return (rows.groupBy(month_start("date").alias("date"), F.lower("country").alias("country"))
                .agg(*[(-F.sum(F.col(c) / F.col("fx_to_usd"))).alias(f"pool_{c}") for c in lines]))


def _margin_sums() -> list[Column]:
    taxed = tax_included(F.col("amount") - F.col("amount_refunded_usd"), "gst_vat")
    return [F.sum("amount").alias("amount"), F.sum("packaging").alias("packaging"), F.sum("cashback").alias("cashback"),
            F.sum(taxed).alias("tax_paid_usd"), F.sum(F.col("amount") * F.col("fee_rate")).alias("gateway_fees"),
            F.sum("amount_refunded_usd").alias("refunds")]


def margin_base(hub: DataFrame) -> DataFrame:
    """Hub rows summed to month x segment x customer with the customer's first month, staged, because the pool shares and the result both read them.

    A customer's rows are in one slice, so the sums, the distinct charges and the first month of one slice at a time are moved.
    """
    hub = hub if is_table(hub) else materialise(hub)
    rows = hub.withColumns({
        "country": F.col("region"), "date": month_start("purchase_date"), "new_existing": F.coalesce("new_existing", F.lit("New")),
        "condition": F.coalesce("condition", F.lit("N/A")), "amount": sale_amount()})
    keys = ["country", "date", "purchase_type", "new_existing", "sales_channel", "condition", "customer_id"]
    n = slices_of(hub)

    def part(k: int) -> DataFrame:
        own = rows.filter(in_slice(k, n, "customer_id"))
        sums = own.groupBy(*keys).agg(*_margin_sums(), F.sum(F.coalesce(F.col("cogs") * F.col("quantity"), F.lit(0.0))).alias("cogs"),
                                      F.countDistinct("charge_id").alias("n_orders"))
        return null_safe_join(sums, own.groupBy("customer_id").agg(F.min("date").alias("acq_month")), ["customer_id"])
    return materialise_parts(hub.sparkSession, map(part, range(n)))


def _prorated(base: DataFrame, spend: DataFrame, t: Tables) -> DataFrame:
    """Delivery, marketing and operating pools spread by revenue share.

    All pools meet in one small table per (month, country, condition), so the big side is joined once. They are summed from the staged rows
    themselves.
    """
    by_condition = base.groupBy("date", "country", "condition").agg(F.sum("amount").alias("total_condition"))
    by_country = by_condition.groupBy("date", "country").agg(F.sum("total_condition").alias("total_country"))
    marketing = (spend.groupBy(month_start("date").alias("date"), F.lower("country_code").alias("country"),
                               F.coalesce("condition", F.lit("N/A")).alias("condition")).agg(F.sum("cost_usd").alias("marketing")))
    pools = (null_safe_join(by_condition, by_country, ["date", "country"])
             .join(delivery_costs(t), ["date", "country"], "left").join(opex(t), ["date", "country"], "left")
             .join(marketing, ["date", "country", "condition"], "left"))
    # staged, so that the planner knows how small they are and does not move the customers' rows
    joined = null_safe_join(base, materialise(pools), ["date", "country", "condition"])
    country_share = safe_divide("amount", "total_country")
    spread = {"delivery_cost": "delivery", "dispensing_fees": "pool_dispensing_fees",
              "operating_expense": "pool_operating_expense", "staff_cost": "pool_staff_cost"}
    out = joined.withColumns({name: country_share * F.coalesce(F.col(pool), F.lit(0.0)) for name, pool in spread.items()})
    share = safe_divide("amount", "total_condition")
    out = out.withColumns({
        "marketing_cost": share * F.coalesce(F.col("marketing"), F.lit(0.0)),
        "cogs": F.when(F.col("condition") == "Services", F.col("pool_teleconsultation_fees") * share).otherwise(F.col("cogs"))})
    return out.drop("total_country", "total_condition", "delivery", "marketing", *[c for c in out.columns if c.startswith("pool_")])


def monthly_contribution_margin(hub: DataFrame, spend: DataFrame, t: Tables, base: DataFrame | None = None) -> DataFrame:
    """Month x segment x customer P&L down to EBITDA. ``base`` is a staged :func:`margin_base` of the hub, which is not read then."""
    return margin_waterfall(_prorated(margin_base(hub) if base is None else base, spend, t))


def consolidated_cm3(hub: DataFrame, spend: DataFrame, t: Tables) -> DataFrame:
    """The same grain down to CM3; a missing direct cost makes the margins NULL."""
    return margin_waterfall(_prorated(margin_base(hub), spend, t), zero_missing=False, ebitda=False)


def charge_base(hub: DataFrame) -> DataFrame:
    """Hub rows summed to month x charge with the customer's first month, staged, because the cohort's sums and the result both read them.

    A customer's rows are in one slice, as in :func:`margin_base`.
    """
    hub = hub if is_table(hub) else materialise(hub)
    rows = hub.select(
        "sales_channel", F.col("region").alias("country"), month_start("purchase_date").alias("purchase_month"), "purchase_type",
        F.coalesce("new_existing", F.lit("New")).alias("new_existing"), "billing_reason",
        F.coalesce("condition", F.lit("N/A")).alias("condition"), "currency", "customer_id", "charge_id", "recurring_interval",
        "recurring_interval_count", "gst_vat", sale_amount().alias("amount"), (F.col("cogs") * F.col("quantity")).alias("cogs"), "packaging", "cashback", "fee_rate",
        "amount_refunded_usd")
    keys = ["sales_channel", "country", "purchase_month", "purchase_type", "new_existing", "billing_reason", "condition", "currency",
            "customer_id", "charge_id", "recurring_interval", "recurring_interval_count", "gst_vat"]
    n = slices_of(hub)

    def part(k: int) -> DataFrame:
        own = rows.filter(in_slice(k, n, "customer_id"))
        sums = (own.groupBy(*keys).agg(*_margin_sums(), F.sum("cogs").alias("cogs"))
                   .withColumnsRenamed({"amount": "revenue", "gateway_fees": "payment_gateway_fees", "gst_vat": "gst_vat_rate"}))
        return null_safe_join(sums, own.groupBy("customer_id").agg(F.min("purchase_month").alias("acq_month")), ["customer_id"])
    return materialise_parts(hub.sparkSession, map(part, range(n)))


def cm3(hub: DataFrame, spend: DataFrame, t: Tables, base: DataFrame | None = None) -> DataFrame:
    """Month x charge margin with prorated pools; marketing goes to customers acquired in the spend month. ``base`` is a staged
    :func:`charge_base` of the hub, which is not read then."""
    base = charge_base(hub) if base is None else base
    by_cohort = base.groupBy("acq_month", "purchase_month", "country").agg(F.sum("revenue").alias("cohort_total"))
    by_month = by_cohort.groupBy("purchase_month", "country").agg(F.sum("cohort_total").alias("month_total"))
    marketing = (spend.groupBy(month_start("date").alias("purchase_month"), F.lower("country_code").alias("country"))
                      .agg(F.sum("cost_usd").alias("marketing")))
    cost = lambda df: df.withColumnRenamed("date", "purchase_month")
    pools = (null_safe_join(by_cohort, by_month, ["purchase_month", "country"])
             .join(cost(delivery_costs(t)), ["purchase_month", "country"], "left")
             .join(cost(opex(t)), ["purchase_month", "country"], "left")
             .join(marketing, ["purchase_month", "country"], "left")
             .withColumn("marketing", F.when(F.col("acq_month") == F.col("purchase_month"), F.col("marketing"))))
    # staged, so that the planner knows how small they are and does not move the charges
    joined = null_safe_join(base, materialise(pools), ["acq_month", "purchase_month", "country"])
    share = safe_divide("revenue", "month_total")
    out = joined.withColumns({
        "prorated_delivery_cost": share * F.col("delivery"),
        "prorated_marketing_cost": safe_divide("revenue", "cohort_total") * F.coalesce(F.col("marketing"), F.lit(0.0)),
        **{c: share * F.col(f"pool_{c}") for c in ("teleconsultation_fees", "dispensing_fees", "operating_expense", "staff_cost")}})
    return (out.withColumnsRenamed({"delivery": "total_delivery_cost", "marketing": "total_marketing_cost"})
               .drop("cohort_total", "month_total", *[c for c in out.columns if c.startswith("pool_")]))


# --- consumers ------------------------------------------------------------------------------------------------------------
def cumulative_revenue(hub: DataFrame) -> DataFrame:
    """Customer x month revenue with acquisition month and running total, card channel."""
    rows = hub.filter(F.col("sales_channel") == "Stripe").select("customer_id", month_start("purchase_date").alias("date"),
                                                                 sale_amount().alias("rev"))
    return cumulative_by(rows, "customer_id", "date", "rev", out="cum_rev")


def monthly_revenue_by_customer(hub: DataFrame, t: Tables) -> DataFrame:
    """Revenue per month, customer, charge and product with subscription interval and cohort month."""
    plan = t["plan"].select(F.col("id").alias("plan_id"), "plan_interval", "interval_count")
    items = t["subscription_item"].select(F.col("subscription_id"), "plan_id").join(plan, "plan_id", "left")
    starts = (t["subscription_history"].select(F.col("id").alias("subscription_id"), month_start(F.to_date("created")).alias("subscription_created"))
              .distinct().join(items.drop("plan_id").distinct(), "subscription_id", "left"))
    keys = ["purchase_month", "sales_channel", "region", "new_existing", "customer_id", "charge_id", "subscription_id", "condition",
            "product_name", "billing_reason", "purchase_type", "subscription_created", "plan_interval", "interval_count"]
    hub = hub if is_table(hub) else materialise(hub)
    n = slices_of(hub)
    rows = hub.withColumn("purchase_month", month_start("purchase_date"))
    with Stages(hub.sparkSession) as owned:
        starts = starts if n == 1 else owned.materialise(starts)

        def part(k: int) -> DataFrame:
            # a customer's rows are in one slice, and so is the cohort month
            own = rows.filter(in_slice(k, n, "customer_id"))
            summed = own.join(starts, "subscription_id", "left").groupBy(*keys).agg(F.sum(sale_amount()).alias("revenue_usd"))
            return null_safe_join(summed, own.groupBy("customer_id").agg(F.min("purchase_month").alias("cohort_month")), ["customer_id"])
        return part(0) if n == 1 else materialise_parts(hub.sparkSession, map(part, range(n)))


def direct_variable_cost(hub: DataFrame, t: Tables) -> DataFrame:
    """Month x country cost of gateway fees, packaging and delivery. One pass over the hub."""
    sums = (hub.groupBy(F.col("region").alias("country"), month_start("purchase_date").alias("date"))
               .agg(F.sum(F.col("fee_rate") * F.col("line_item_amount_usd")).alias("fees"), F.sum("packaging").alias("packaging")))
    kinds = F.explode(F.array(F.struct(F.lit("Payment Gateway Fees").alias("type"), F.col("fees").alias("cost")),
                              F.struct(F.lit("Packaging").alias("type"), F.col("packaging").alias("cost"))))
    direct = sums.select("date", "country", kinds.alias("k")).select("date", "country", "k.type", "k.cost")
    delivery = delivery_costs(t).select("date", "country", F.lit("Delivery").alias("type"), F.col("delivery").alias("cost"))
    return direct.unionByName(delivery)


def subscription_renewals(hub: DataFrame, days: int = 90) -> DataFrame:
    """Charges and amount in the first 90 days after a subscription's first paid line."""
    paid = hub.filter(F.col("subscription_id").isNotNull() & (sale_amount() > 0))
    starts = paid.groupBy("region", "subscription_id", "condition").agg(F.min("purchase_date").alias("created_date"))
    facts = hub.select("subscription_id", "condition", "purchase_date", "charge_id", F.coalesce(sale_amount(), F.lit(0.0)).alias("amount"))
    return activity_within(starts, facts, ["subscription_id", "condition"], "created_date", "purchase_date", days,
                           "charge_id", "amount", "n_charges_in_first_90d", "amount_usd_in_first_90d")


def trailing_months(date: str, as_of, months: int) -> Column:
    """Test for the ``months`` full months before the month of ``as_of``."""
    this_month = F.trunc(F.lit(as_of).cast("date"), "MM")
    return (F.col(date) >= F.add_months(this_month, -months)) & (F.col(date) < this_month)


def investor_summary(monthly: DataFrame, as_of, months: int = 13) -> DataFrame:
    """Rounded P&L per month and segment over the trailing full months."""
    sums = ["gross_revenue", "net_revenue", "cogs", "gross_profit", "gateway_fees", "delivery_cost", "packaging", "cm2",
            "marketing_cost", "cm3", "operating_expense", "staff_cost", "ebitda"]
    value = {c: F.col(c) for c in sums} | {"cogs": F.coalesce("cogs", F.lit(0.0))}
    return (monthly.filter(trailing_months("date", as_of, months))
            .groupBy("date", "country", "condition", "new_existing", "purchase_type", "sales_channel")
            .agg(*[F.round(F.sum(value[c]), 0).alias(c) for c in sums], F.sum("n_orders").alias("n_orders")))


def pnl_by_condition(hub: DataFrame, t: Tables, region: str = "sg") -> DataFrame:
    category = F.when(F.col("product_name").startswith("Telecons"), "Teleconsultation").otherwise(F.col("condition"))
    rows = with_rate(hub.filter(F.col("region") == region), "currency", t["fx"])
    return (rows.groupBy("region", "sales_channel", month_start("purchase_date").alias("purchase_month"), "purchase_type", category.alias("category"))
                .agg(F.countDistinct("customer_id").alias("n_customers"), F.sum(sale_amount()).alias("revenue_usd"),
                     F.sum(sale_amount() * F.col("fx_to_usd")).alias("revenue_local")))


def pnl_metrics(margin: DataFrame, t: Tables, base: DataFrame | None = None) -> DataFrame:
    """Monthly P&L lines per segment, in USD and local revenue, from :func:`cm3`.

    Sums are combined before they are moved; customers and charges are counted by themselves, not on one copy of the rows for each count, and
    in the staged :func:`charge_base` of the margin where ``base`` gives it.
    """
    keys = ["sales_channel", "country", "purchase_month", "purchase_type", "billing_reason", "currency", "new_existing", "condition"]
    lines = {"cogs_usd": "cogs", "refunds_usd": "refunds", "gst_vat_usd": "tax_paid_usd", "packaging_usd": "packaging",
             "payment_gateway_fees_usd": "payment_gateway_fees", "marketing_cost_usd": "prorated_marketing_cost",
             "delivery_cost_usd": "prorated_delivery_cost", "dispensing_fees_usd": "dispensing_fees", "staff_cost_usd": "staff_cost",
             "teleconsultation_fees_usd": "teleconsultation_fees", "operating_expense_usd": "operating_expense"}
    sums = (with_rate(margin, "currency", t["fx"]).groupBy(*keys)
            .agg(F.sum("revenue").alias("revenue_usd"), F.sum(F.col("revenue") * F.col("fx_to_usd")).alias("revenue_local"),
                 *[F.sum(c).alias(name) for name, c in lines.items()]))
    base = materialise(margin.select(*keys, "customer_id", "charge_id")) if base is None else base
    for entity, out in (("customer_id", "n_customers"), ("charge_id", "n_charges")):
        sums = null_safe_join(sums, count_distinct_by(base, keys, entity, out), keys)
    return sums.select(*keys, "n_customers", "n_charges", "revenue_usd", "revenue_local", *lines)

"""Advertising spend, acquisition cost and return-on-spend jobs."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import CHANNEL_PREFIXES, FUNNEL_SOURCES, map_channel, month_start
from ..operators.dedup import latest_per_key
from ..operators.margin import kpi_ratios, period_change
from ..operators.metrics import annual_totals, merge_metrics, reconcile, unmapped
from ..operators.money import with_rate
from ..operators.scoring import score_rows
from ..sources.writers import in_slice, materialise_parts, slices_of
from .finance import sale_amount, trailing_months
from .payments import succeeded

Tables = Mapping[str, DataFrame]

SPEND_COLUMNS = ["channel", "date", "campaign_name", "condition", "currency_code", "country_code"]
SPEND_MEASURES = ["reach", "clicks", "impressions", "cost_local", "cost_usd"]


# --- newest versions of the platform tables ---------------------------------------------------------------------------
def google_accounts(t: Tables) -> DataFrame:
    return latest_per_key(t["google_account"], ["id"], ["updated_at"], tie_break=["currency_code"]).select(
        F.col("id").alias("customer_id"), "currency_code")


def google_campaigns(t: Tables) -> DataFrame:
    return latest_per_key(t["google_campaign"], ["id"], ["updated_at"], tie_break=["name"]).select(
        F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name"))


def google_countries(t: Tables) -> DataFrame:
    """Newest targeted country per campaign."""
    target = latest_per_key(t["google_target"].filter("geo_target_id is not null"), ["campaign_id"], ["updated_at"],
                            tie_break=["geo_target_id"])
    geo = t["geo_target"].select(F.col("id").alias("geo_target_id"), "country_code")
    return target.join(geo, "geo_target_id", "left").select("campaign_id", "country_code")


def facebook_accounts(t: Tables) -> DataFrame:
    return latest_per_key(t["fb_account"], ["id"], ["created_time"], tie_break=["currency"]).select(
        F.col("id").cast("string").alias("account_id"), F.col("currency").alias("currency_code"))


def facebook_countries(t: Tables) -> DataFrame:
    """Targeted countries per ad: newest ad version to newest ad set version."""
    ads = latest_per_key(t["fb_ad"], ["id"], ["updated_time"], tie_break=["ad_set_id"]).select(
        F.col("id").cast("string").alias("ad_id"), F.col("ad_set_id").cast("string").alias("ad_set_id"))
    sets = latest_per_key(t["fb_ad_set"], ["id"], ["updated_time"], tie_break=["countries"]).select(
        F.col("id").cast("string").alias("ad_set_id"), F.regexp_replace("countries", r'[\[\]"]', "").alias("country_code"))
    return ads.join(sets, "ad_set_id", "left").select("ad_id", "country_code")


def facebook_rows(t: Tables) -> DataFrame:
    """Ad-day rows with any reach, click rate or spend, with text keys."""
    active = t["fb_levels"].filter((F.col("reach") > 0) | (F.col("ctr") > 0) | (F.col("spend") > 0))
    return active.withColumns({"ad_id": F.col("ad_id").cast("string"), "account_id": F.col("account_id").cast("string"),
                               "clicks": F.col("ctr") * F.col("impressions") / 100})


# --- spend hub ------------------------------------------------------------------------------------------------------------
def _spend(df: DataFrame, channel: Column, *, by: list[str], t: Tables, **measures: Column) -> DataFrame:
    """Sum a channel's rows, adding USD cost. Measures are in platform units, ``cost_local`` among them."""
    rated = with_rate(df, "currency_code", t["fx"])
    sums = {m: F.sum(c) for m, c in measures.items()}
    sums["cost_usd"] = F.sum(measures["cost_local"] / F.col("fx_to_usd"))
    out = rated.groupBy(channel.alias("channel"), *by).agg(*[c.cast("double").alias(m) for m, c in sums.items()])
    missing = [c for c in SPEND_COLUMNS if c not in out.columns]
    lacking = [m for m in SPEND_MEASURES if m not in out.columns]
    out = out.withColumns({**{c: F.lit(None).cast("string") for c in missing}, **{m: F.lit(None).cast("double") for m in lacking}})
    return out.select(*SPEND_COLUMNS, *SPEND_MEASURES)


def marketing_spend(t: Tables) -> DataFrame:
    """Channel x day x campaign x country spend of four sources (hub)."""
    condition = t["campaign_condition"].select("campaign_name", "condition")
    by = ["date", "campaign_name", "condition", "currency_code", "country_code"]

    # the platform's micros are summed per campaign and day before the lookups widen the rows
    stats = (t["google_stats"].groupBy(F.col("id").alias("campaign_id"), "customer_id", "date")
             .agg(*[F.sum(c).alias(c) for c in ("clicks", "impressions", "cost_micros")]))
    google = (stats.join(google_campaigns(t), "campaign_id", "left").join(google_countries(t), "campaign_id", "left")
              .join(google_accounts(t), "customer_id", "left").join(condition, "campaign_name", "left"))
    google = _spend(google, F.lit("google_ads"), by=by, t=t, clicks=F.col("clicks"), impressions=F.col("impressions"),
                    cost_local=F.col("cost_micros") / 1000000)

    facebook = (facebook_rows(t).join(facebook_countries(t), "ad_id", "left").join(facebook_accounts(t), "account_id", "left")
                .join(condition, "campaign_name", "left"))
    facebook = _spend(facebook, F.lit("facebook_ads"), by=by, t=t, reach=F.col("reach"), clicks=F.col("clicks"),
                      impressions=F.col("impressions"), cost_local=F.col("spend"))

    # a campaign that targets several countries shows its whole spend in each; summed per day before the countries widen the rows
    campaign = t["taboola_campaign"].select(F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name"))
    target = t["taboola_target"].select("campaign_id", F.col("value").alias("country_code"))
    report = (t["taboola_report"].groupBy("campaign_id", "date", F.col("currency").alias("currency_code"))
              .agg(*[F.sum(c).alias(c) for c in ("clicks", "impressions", "spent")]))
    taboola = (report.join(campaign, "campaign_id", "left").join(target, "campaign_id", "left").join(condition, "campaign_name", "left"))
    taboola = _spend(taboola, F.lit("taboola"), by=by, t=t, reach=F.lit(0), clicks=F.col("clicks"), impressions=F.col("impressions"),
                     cost_local=F.col("spent"))

    manual = t["manual_spend"].withColumnsRenamed({"currency": "currency_code", "country": "country_code"})
    manual = _spend(manual, F.col("supplier"), by=["date", "condition", "currency_code", "country_code"], t=t,
                    reach=F.lit(0), clicks=F.lit(0), impressions=F.lit(0), cost_local=F.col("amount"))
    return reduce(DataFrame.unionByName, [google, facebook, taboola, manual])


# the tables whose rows the spend sums by day and more
SPEND_FACTS = ["google_stats", "fb_levels", "taboola_report", "manual_spend"]


def staged_spend(t: Tables) -> DataFrame:
    """:func:`marketing_spend` for a hub; of large tables it is worked in slices of the days, and staged."""
    facts = {name: t[name] for name in SPEND_FACTS}
    n = slices_of(*facts.values())
    if n == 1:
        return marketing_spend(t)
    parts = (marketing_spend(ChainMap({name: df.filter(in_slice(k, n, "date")) for name, df in facts.items()}, t)) for k in range(n))
    return materialise_parts(facts["fb_levels"].sparkSession, parts)


def google_spend(t: Tables) -> DataFrame:
    """Campaign x day spend without country, as compared with the platform export."""
    stats = t["google_stats"].withColumnRenamed("id", "campaign_id").join(google_campaigns(t), "campaign_id", "left")
    rows = stats.join(google_accounts(t), "customer_id", "left")
    return rows.groupBy("date", "campaign_name", "currency_code").agg(
        F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"),
        (F.sum("cost_micros") / 1000000).alias("cost_local"))


def facebook_spend(t: Tables) -> DataFrame:
    rows = facebook_rows(t).join(facebook_accounts(t), "account_id", "left")
    return rows.groupBy(F.lit("facebook_ads").alias("channel"), "date", "campaign_name", "currency_code").agg(
        F.sum("reach").alias("reach"), F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"),
        F.sum("spend").alias("cost_local"))


def spend_reconciliation(exports: Mapping[str, DataFrame], warehouse: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(month x channel: export against warehouse, year x channel export totals).

    Frames hold ``date`` and ``cost_local`` per channel.
    """
    tag = lambda frames: reduce(DataFrame.unionByName, [df.select(F.lit(c).alias("channel"), "date", "cost_local") for c, df in frames.items()])
    monthly = reconcile(tag(exports), tag(warehouse), "date", "cost_local", ["channel"])
    return monthly, annual_totals(monthly, "month", "cost_local_export", ["channel"])


# --- action cost and acquisition ------------------------------------------------------------------------------------------
def utm_source_map(t: Tables) -> DataFrame:
    """Distinct raw traffic source to channel."""
    return (t["page_event"].select("context_campaign_source").distinct()
            .withColumn("channel", map_channel("context_campaign_source", CHANNEL_PREFIXES, ignore_case=True)))


def _action_counts(t: Tables, sources: DataFrame) -> DataFrame:
    """Sign-ups, answered forms and checkouts per day, country, channel and condition.

    The three are one stream of tagged events, so the largest table, that of all tracked moments, is joined once.
    """
    checkout = t["checkout"].join(t["checkout_product"].filter(F.col("name") == "Teleconsultation")
                                  .select("message_id", F.col("condition").alias("raw")), "message_id")
    kinds = {"n_signups": (t["signed_up"], "condition"), "n_q3_completions": (t["eval_step"], "evaluation_type"), "n_checkouts_completed": (checkout, "raw")}
    events = reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("what"), "message_id", "region", "utm_source", F.col(raw).alias("raw")) for name, (df, raw) in kinds.items()])
    day = t["tracks"].select("message_id", F.to_date("ts").alias("date"))
    source = sources.withColumnRenamed("context_campaign_source", "utm_source")
    label = t["condition_map"].select(F.col("raw_condition").alias("raw"), F.col("condition").alias("label"))
    joined = events.join(day, "message_id").join(source, "utm_source", "left").join(label, "raw", "left")
    keys = {"date": F.col("date"), "country": F.lower("region"), "channel": F.coalesce("channel", F.lit("N/A")), "condition": F.coalesce("label", F.lit("N/A"))}
    # one distinct count for all three; sign-ups count rows
    counts = joined.groupBy("what", *[c.alias(k) for k, c in keys.items()]).agg(F.count("message_id").alias("_rows"), F.countDistinct("message_id").alias("_messages"))
    number = F.when(F.col("what") == "n_signups", F.col("_rows")).otherwise(F.col("_messages"))
    return counts.groupBy(*keys).agg(*[F.sum(F.when(F.col("what") == name, number)).alias(name) for name in kinds])


def marketing_cost_per_action(t: Tables, spend: DataFrame, appointments: DataFrame, since: str = "2025-01-27") -> DataFrame:
    """Day x country x channel x condition: ad metrics beside sign-ups, form completions, checkouts and consults."""
    keys = ["date", "country", "channel", "condition"]
    facts = [
        spend.groupBy("date", F.lower("country_code").alias("country"), "channel", F.coalesce("condition", F.lit("N/A")).alias("condition"))
             .agg(F.sum("impressions").alias("ad_impressions"), F.sum("cost_usd").alias("cost_usd"), F.sum("clicks").alias("clicks")),
        _action_counts(t, utm_source_map(t)),
        appointments.groupBy("date", F.col("region").alias("country"), F.coalesce("utm_source", F.lit("N/A")).alias("channel"),
                             F.coalesce("condition", F.lit("N/A")).alias("condition"))
                    .agg(F.countDistinct("consult_sys_id").alias("n_consults"))]
    wanted = [f.filter((F.col("date") >= F.lit(since).cast("date")) & F.col("country").isNotNull()) for f in facts]
    return merge_metrics(keys, wanted)


def marketing_summary(actions: DataFrame, as_of, months: int = 13) -> DataFrame:
    rows = actions.filter(trailing_months("date", as_of, months))
    return rows.groupBy(month_start("date").alias("date"), "channel", "country", "condition").agg(
        F.sum(F.round("cost_usd", 0)).alias("ad_spend"), F.sum("ad_impressions").alias("ad_impressions"),
        F.sum(F.round("clicks", 0)).alias("ad_clicks"), F.sum("n_checkouts_completed").alias("n_checkouts_completed"),
        F.sum("n_consults").alias("n_consultations"), F.sum("n_q3_completions").alias("n_q3_completions"))


def merged_condition(condition: str = "condition") -> Column:
    c = F.col(condition)
    return F.when(c.isin("ED", "PE"), "ED + PE").when(c.isNotNull(), c).otherwise("N/A")


def daily_roas(hub: DataFrame, spend: DataFrame) -> DataFrame:
    """Day x country x condition x brand: spend beside revenue and new customers. A missing brand is a key value."""
    brand = F.col("brand") if "brand" in spend.columns else F.lit(None).cast("string").alias("brand")
    keys = ["date", "country", "condition", "brand"]
    ads = (spend.withColumn("condition", merged_condition())
           .groupBy("date", F.lower("country_code").alias("country"), "condition", brand)
           .agg(F.sum(F.round("cost_usd", 2)).alias("marketing_spend"), F.sum("impressions").alias("impressions"),
                F.sum(F.round("clicks", 0)).alias("clicks")))
    new = F.col("new_existing") == "New"
    sales = (hub.withColumn("condition", merged_condition())
             .groupBy(F.col("purchase_date").alias("date"), F.col("region").alias("country"), "condition", "brand")
             .agg(F.sum(sale_amount()).alias("revenue"), F.countDistinct(F.when(new, F.col("customer_id"))).alias("n_new_customers"),
                  F.sum(F.when(new, sale_amount()).otherwise(F.lit(0.0))).alias("first_purchase_amount")))
    return merge_metrics(keys, [ads, sales], fill={"n_new_customers": 0, "first_purchase_amount": 0.0})


def daily_roas_by_ad(t: Tables) -> DataFrame:
    """Day x ad x country: clicks, cost and attributed purchase value in local currency and USD."""
    stats = t["google_stats"].withColumnRenamed("id", "campaign_id")
    google = (stats.join(google_campaigns(t), "campaign_id", "left").join(google_countries(t), "campaign_id", "left")
              .join(google_accounts(t), "customer_id", "left"))
    google = google.groupBy(F.lit("google_ads").alias("channel"), "date", F.lower("country_code").alias("country"),
                            F.lower("currency_code").alias("currency"), F.col("ad_id").cast("string").alias("ad_id"), "campaign_name").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").cast("double").alias("clicks"),
        F.sum(F.col("cost_micros") / 1e6).alias("cost_local"), F.sum("conversions_value").alias("purchases_local"))
    facebook = (facebook_rows(t).join(facebook_countries(t), "ad_id", "left").join(facebook_accounts(t), "account_id", "left")
                .groupBy(F.lit("facebook_ads").alias("channel"), "date", F.lower("country_code").alias("country"),
                         F.lower("currency_code").alias("currency"), "ad_id", "campaign_name").agg(
                    F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"), F.sum("spend").alias("cost_local")))
    value = t["fb_purchase"].select("date", F.col("ad_id").cast("string").alias("ad_id"), F.col("value").alias("purchases_local"))
    both = google.unionByName(facebook.join(value, ["date", "ad_id"], "left"))
    condition = t["campaign_condition"].select("campaign_name", "condition")
    fx = F.col("fx_to_usd")
    return (with_rate(both, "currency", t["fx"]).join(condition, "campaign_name", "left")
            .select(*both.columns, "condition", (F.col("cost_local") / fx).alias("cost_usd"),
                    (F.col("purchases_local") / fx).alias("purchases_usd")))


def cost_per_completion(t: Tables) -> DataFrame:
    """Campaign x source x day: form completions, page visits, spend and clicks.

    Both platforms are summed per campaign name and day first. A campaign name that both platforms use keeps the
    first platform's figures once per matching row of the second, as a row-level join of the two would.
    """
    day = t["tracks"].select("message_id", F.to_date("ts").alias("date"))
    campaign = F.regexp_replace(F.substring_index("utm_campaign", ",", 1), "_[0-9]+$", "")
    done = (t["eval_step"].join(day, "message_id", "left")
            .groupBy(campaign.alias("utm_campaign"), map_channel("utm_source", FUNNEL_SOURCES).alias("utm_source"), "date")
            .agg(F.countDistinct("message_id").alias("completions")))
    visits = (t["page_event"].groupBy(F.to_date("ts").alias("date"), map_channel("context_campaign_source", FUNNEL_SOURCES).alias("utm_source"))
              .agg(F.count("message_id").alias("page_visits")))
    fb_ccy = latest_per_key(t["fb_account"], ["id"], ["created_time"], tie_break=["currency"]).select(F.col("id").alias("account_id"), F.col("currency").alias("ccy"))
    fb = with_rate(t["fb_campaign_daily"].join(fb_ccy, "account_id", "left"), "ccy", t["fx"])
    fb = fb.groupBy(F.col("campaign_name").alias("utm_campaign"), "date").agg(
        F.sum(F.col("spend") / F.col("fx_to_usd")).alias("fb_usd"), F.sum(F.col("ctr") * F.col("impressions") / 100).alias("fb_clicks"),
        F.count(F.lit(1)).alias("fb_rows"))
    names = t["google_campaign"].select("id", F.col("name").alias("utm_campaign")).distinct()
    ga = with_rate(t["google_stats"].join(google_accounts(t), "customer_id", "left"), "currency_code", t["fx"]).join(names, "id")
    ga = ga.groupBy("utm_campaign", "date").agg(
        F.sum(F.col("cost_micros") / 1e6 / F.col("fx_to_usd")).alias("ga_usd"), F.sum("clicks").alias("ga_clicks"),
        F.count(F.lit(1)).alias("ga_rows"), F.countDistinct("id").alias("ga_ids"))
    ids = names.groupBy("utm_campaign").agg(F.count(F.lit(1)).alias("n_ids"))
    joined = (done.join(visits, ["utm_source", "date"], "left").join(fb, ["utm_campaign", "date"], "left")
              .join(ga, ["utm_campaign", "date"], "left").join(ids, "utm_campaign", "left").fillna(0, ["ga_rows", "ga_ids", "n_ids"]))
    # rows of the second platform: its day rows, and one for every campaign id without a row that day
    times = F.greatest(F.col("ga_rows") + F.col("n_ids") - F.col("ga_ids"), F.lit(1))
    on_fb = F.col("fb_rows").isNotNull()
    return joined.select("utm_campaign", "utm_source", "date", "completions", "page_visits",
                         F.when(on_fb, F.col("fb_usd") * times).otherwise(F.col("ga_usd")).alias("spend_usd"),
                         F.when(on_fb, F.col("fb_clicks") * times).otherwise(F.col("ga_clicks")).alias("clicks"))


def acquisition_months(t: Tables) -> DataFrame:
    """First month with a successful charge per region and customer."""
    return (succeeded(t).groupBy("region", "customer_id")
            .agg(month_start(F.min(F.to_date("created"))).alias("acquired")))


def _month_spend(spend: DataFrame, case) -> DataFrame:
    return spend.groupBy(month_start("date").alias("date"), case("country_code").alias("country")).agg(
        F.sum("cost_usd").alias("marketing_spend"))


def _first_of_month_mrr(metrics: DataFrame) -> DataFrame:
    rows = metrics.filter((F.col("obs_date") == month_start("obs_date")) & (F.col("mrr_usd") > 0))
    return rows.groupBy(F.col("obs_date").alias("date"), F.col("region").alias("country")).agg(
        F.countDistinct("customer_id").alias("total_subscribers"), F.sum("mrr_usd").alias("mrr"))


def cac(t: Tables, hub: DataFrame, spend: DataFrame, metrics: DataFrame) -> DataFrame:
    """Month x country: spend, subscription revenue and cost lines, MRR and new customers. Every side is summed first."""
    amount = sale_amount()
    lines = (hub.filter(F.col("purchase_type") == "Subscription")
             .groupBy(month_start("purchase_date").alias("date"), F.lower("region").alias("country"))
             .agg(F.sum(amount).alias("revenue"), F.sum(F.col("cogs") * F.col("quantity")).alias("cogs"), F.sum(F.col("gst_vat") * amount).alias("gst_vat_usd"),
                  F.sum(F.col("refund_rate") * amount).alias("refund_usd")))
    new = (acquisition_months(t).groupBy(F.col("acquired").alias("date"), F.lower("region").alias("country"))
           .agg(F.countDistinct("customer_id").alias("n_new_customers")))
    mrr = _first_of_month_mrr(metrics).drop("total_subscribers")
    key = ["date", "country"]
    return (_month_spend(spend, F.lower).join(new, key, "left").join(lines, key, "left").join(mrr, key, "left")
            .withColumn("n_new_customers", F.coalesce("n_new_customers", F.lit(0))).withColumn("country", F.upper("country"))
            .select("date", "country", "marketing_spend", "revenue", "cogs", "gst_vat_usd", "refund_usd", "mrr", "n_new_customers"))


def cac_margin(t: Tables, monthly: DataFrame, metrics: DataFrame) -> DataFrame:
    """Month x country subscription margin lines with MRR, subscribers and new customers."""
    acquired = acquisition_months(t).select(F.col("acquired").alias("date"), F.col("region").alias("country"), "customer_id",
                                            F.lit(True).alias("is_new"))
    rows = monthly.filter(F.col("purchase_type") == "Subscription").join(acquired, ["date", "country", "customer_id"], "left")
    lines = {"marketing_cost": "marketing_cost", "revenue": "gross_revenue", "cogs": "cogs", "cashback": "cashback",
             "packaging": "packaging", "tax_paid_usd": "tax_paid_usd", "refunds": "refunds", "payment_gateway_fees": "gateway_fees",
             "delivery_cost": "delivery_cost"}
    sums = rows.groupBy("date", "country").agg(*[F.sum(c).alias(n) for n, c in lines.items()],
                                               F.countDistinct(F.when(F.col("is_new"), F.col("customer_id"))).alias("n_new_customers"))
    return (sums.join(_first_of_month_mrr(metrics), ["date", "country"], "left")
                .select("date", "country", "mrr", "total_subscribers", *lines, "n_new_customers"))


def roas_monthly(hub: DataFrame, spend: DataFrame) -> DataFrame:
    """Month x country: revenue, spend, new customers and their first month's revenue."""
    by_customer = (hub.groupBy("customer_id", month_start("purchase_date").alias("date"), F.col("region").alias("country"))
                      .agg(F.sum(sale_amount()).alias("rev")))
    revenue = by_customer.groupBy("date", "country").agg(F.sum("rev").alias("revenue"))
    first = latest_per_key(by_customer, ["customer_id"], ["date"], desc=False, tie_break=["country"])
    acquired = first.groupBy("date", "country").agg(F.countDistinct("customer_id").alias("n_new_customers"),
                                                    F.sum("rev").alias("first_purchase_revenue"))
    return (revenue.join(_month_spend(spend, F.lower), ["date", "country"]).join(acquired, ["date", "country"], "left")
            .select("date", "country", "revenue", "marketing_spend",
                    F.coalesce("n_new_customers", F.lit(0)).alias("n_new_customers"), "first_purchase_revenue"))


def monthly_cac(monthly: DataFrame, spend: DataFrame, as_of, months: int = 12, by_condition: bool = False) -> DataFrame:
    """Month x country (x condition): rounded spend and distinct new customers over the trailing full months."""
    keys = ["date", "country", *["condition"][:by_condition]]
    ads = (spend.filter("country_code is not null")
           .select(month_start("date").alias("date"), F.lower("country_code").alias("country"),
                   F.coalesce("condition", F.lit("N/A")).alias("condition"), "cost_usd")
           .groupBy(*keys).agg(F.round(F.sum("cost_usd"), 0).alias("marketing_spend")))
    new = (monthly.filter(F.col("country").isNotNull()).groupBy(*keys)
           .agg(F.countDistinct(F.when(F.col("new_existing") == "New", F.col("customer_id"))).alias("n_new_customers")))
    merged = merge_metrics(keys, [ads, new])
    return merged.filter(trailing_months("date", as_of, months))


def kpi_report(cac_rows: DataFrame) -> DataFrame:
    """CAC with its change on the month and the year before; rows labelled N/A are left out."""
    rows = kpi_ratios(cac_rows.filter(F.col("country") != "N/A"))
    rows = period_change(rows, "date", "cac", ["country"], 1, "cac_mom")
    return period_change(rows, "date", "cac", ["country"], 12, "cac_yoy")


def segment_ratios(summary: DataFrame) -> DataFrame:
    """Gross margin, order value and EBITDA margin per month, country and condition, without N/A rows."""
    named = summary.filter((F.col("country") != "N/A") & (F.col("condition") != "N/A"))
    sums = named.groupBy("date", "country", "condition").agg(
        *[F.sum(c).alias(c) for c in ("gross_revenue", "net_revenue", "gross_profit", "ebitda", "n_orders")])
    return kpi_ratios(sums)


def new_campaigns(t: Tables, spend: DataFrame, channel: str = "facebook_ads") -> DataFrame:
    """Campaign names of a channel that the condition sheet lacks, ignoring case."""
    known = t["campaign_condition"].filter(F.col("channel") == channel)
    # distinct at once, so that the planner leaves out the sums and lookups of a spend that is not staged
    names = spend.filter(F.col("channel") == channel).select("campaign_name").distinct()
    return unmapped(names, known, ["campaign_name"], ignore_case=True)


def recent_creatives(t: Tables, as_of, months: int = 3) -> DataFrame:
    """Distinct creative ids of ads created in the last months."""
    recent = t["fb_ad"].filter(F.col("created_time") >= F.add_months(F.lit(as_of).cast("date"), -months))
    return recent.select(F.col("creative_id").cast("string").alias("creative_id")).distinct()


def classify_creatives(creatives: DataFrame, fn, schema) -> DataFrame:
    """Run a caller's model over distinct creatives (columns creative_id and image_url)."""
    return score_rows(creatives, "creative_id", ["image_url"], "image_url", fn, schema, "No image_url")

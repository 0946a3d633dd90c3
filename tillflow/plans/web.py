"""Web funnel and application jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions import PAGE_MEDIUMS, PAGE_SOURCES, map_channel, parse_datetime, regex_group
from ..functions.scalars import json_scalar
from ..operators.dedup import latest_per_key
from ..operators.metrics import merge_metrics
from ..operators.sequence import daily_counts, first_touch_funnel
from ..operators.variants import flatten_variant
from ..sources.regions import all_regions
from .payments import condition_of

Tables = Mapping[str, DataFrame]

# Fields of an order's price calculation and their types.
CALCULATION_FIELDS = {
    "total": "bigint", "mainTax": "bigint", "subTotal": "bigint", "isConsult": "boolean", "consultFee": "bigint",
    "consultTax": "bigint", "mainBasePrice": "bigint", "cashbackEarned": "bigint", "discountAmount": "bigint",
    "cashbackEarnRate": "double", "cashbackRedeemed": "bigint", "consultBasePrice": "bigint", "productPriceAmount": "bigint",
    "totalAfterCashback": "bigint", "paymentIntentAmount": "bigint", "minimalAmountPayment": "bigint",
    "paymentIntentAmountAfterCashback": "bigint", "shouldChargeConsultFee": "boolean", "consultFeeAfterDiscount": "bigint",
    "productPriceAmountAfterDiscount": "bigint",
}
# Fields of an instalment provider's notification.
PAYLOAD_FIELDS = {
    "refundableAmount": "bigint", "merchantReferenceId": "string", "payment_tenor": ("paymentTransaction.tenor", "bigint"),
    "orderId": ("paymentTransaction.orderId", "string"), "payment_createAt": ("paymentTransaction.createAt", "bigint"),
    "payment_transactionId": ("paymentTransaction.transactionId", "string"),
}
# Application tables that exist once per region.
APPLICATION_TABLES = ["acuity_appointment", "order_acuity_appointment", "user", "consultation_audit", "consultation_sessions"]


def application_views(regional: Mapping[str, Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    return all_regions(regional)


def _event_day(t: Tables) -> DataFrame:
    return t["tracks"].select("message_id", F.to_date("ts").alias("day"))


# --- funnel -----------------------------------------------------------------------------------------------------------
def consultations_created(t: Tables) -> DataFrame:
    """Country x day distinct teleconsultation orders."""
    wanted = t["checkout_product"].filter(F.col("condition") == "teleconsultation").select("message_id")
    rows = t["checkout"].join(wanted, "message_id", "left_semi").join(_event_day(t), "message_id")
    return daily_counts(rows, F.col("day"), ["country"], "order_id", "n_consultations_created")


def checkout_completions(t: Tables) -> DataFrame:
    """Day x country: consultations created beside consultations scheduled."""
    pending = t["app_order"].filter(F.col("status") == "pending_prescription").select(F.col("sys_id").alias("order_id"))
    rows = t["order_completed"].join(pending, "order_id", "left_semi").join(_event_day(t), "message_id")
    scheduled = daily_counts(rows, F.col("day"), ["country"], "order_id", "consultations_scheduled")
    return consultations_created(t).join(scheduled, ["date", "country"], "full_outer")


def order_completions(t: Tables) -> DataFrame:
    """Day x country: orders created and orders completed."""
    done = t["order_completed"].select("order_id").distinct()
    rows = t["app_order"].join(done, F.col("sys_id") == F.col("order_id"), "left")
    return rows.groupBy(F.to_date("created_at").alias("date"), "country").agg(
        F.countDistinct("sys_id").alias("orders_created"), F.countDistinct("order_id").alias("orders_completed"))


def eval_funnel(t: Tables) -> DataFrame:
    """User: first evaluation, first view of the fourth question, attributes of the first evaluation event."""
    touched = first_touch_funnel(t["tracks"], "user_id", "event", "ts", "message_id", "Evaluation Updated",
                                 "Viewed 4th Question Of Eval", "start_time", "viewed_4_time")
    return (touched.join(t["evaluation_updated"], "message_id", "left")
            .select("user_id", "start_time", "viewed_4_time", "platform", "region", "evaluation_type"))


def page_views_by_condition(t: Tables) -> DataFrame:
    """Day x region x condition: page views beside form views."""
    product = t["product"].select(F.col("id").alias("product_id"), condition_of("metadata").alias("from_product"))
    names = t["condition_map"].select(F.col("raw_condition").alias("raw"), F.col("condition").alias("from_name"))
    pages = (t["page_event"].withColumn("raw", regex_group("name", "Health Profile - ([^-]+) -"))
             .join(product, "product_id", "left").join(names, "raw", "left")
             .withColumn("condition", F.coalesce("from_product", "from_name")).filter("condition is not null"))
    views = daily_counts(pages, F.to_date("ts"), ["region", "condition"], "message_id", "total_views")
    forms = (t["eval_step"].join(_event_day(t), "message_id")
             .join(names.withColumnRenamed("raw", "evaluation_type"), "evaluation_type", "left"))
    q4 = daily_counts(forms.withColumnRenamed("from_name", "condition"), F.col("day"), ["region", "condition"], "message_id", "q4_views")
    return views.join(q4, ["date", "region", "condition"], "left")


def page_visits(t: Tables) -> DataFrame:
    """Page events with mapped source and medium."""
    return t["page_event"].select(
        F.to_date("ts").alias("date"), "category", F.upper("region").alias("country"), "product", "platform",
        map_channel("context_campaign_source", PAGE_SOURCES, match="contains").alias("campaign_source"),
        map_channel("context_campaign_medium", PAGE_MEDIUMS, match="contains").alias("campaign_medium"), "user_id")


def followup_attendance(t: Tables) -> DataFrame:
    """Follow-up bookings with the user's attendance records, one row per distinct attendance and its record count.

    Records are summed per user and attendance first, so a user's bookings are not paired with every single record.
    """
    user = t["tracks"].select("message_id", "user_id")
    seen = (t["attendance"].join(user, "message_id").groupBy("user_id", "attendance").agg(F.count(F.lit(1)).alias("n_records")))
    rows = t["followup"].join(user, "message_id", "left").join(seen, "user_id", "left")
    return rows.select(F.to_date(parse_datetime("schedule_date")).alias("appt_date"), "user_id", F.col("region").alias("country"),
                       "platform", F.col("product_name").alias("product"), "consult_type", "attendance", "n_records")


def upgrade_intent(t: Tables) -> DataFrame:
    """Day x region: users on the landing page, users on the plan page, new customers."""
    day = F.to_date("ts").alias("date")
    landing, plans = "Upgrade Introduction Page", "Select Upgrade Plans Page"
    pages = t["page_event"].filter(F.col("name").isin(landing, plans) | (F.col("category") == landing))
    on_landing = (F.col("name") == landing) | (F.col("category") == landing)
    visits = pages.groupBy(day, "region").agg(
        F.countDistinct(F.when(on_landing, F.col("user_id"))).alias("n_landing"),
        F.countDistinct(F.when(F.col("name") == plans, F.col("user_id"))).alias("n_upgrades"))
    new = (t["subscription_history"].filter(F.col("status") == "active")
           .groupBy(F.to_date("created").alias("date"), "region").agg(F.countDistinct("customer_id").alias("n_new_customers")))
    return merge_metrics(["date", "region"], [visits, new]).orderBy("region", F.col("date").desc())


# --- application --------------------------------------------------------------------------------------------------------
def cod_order_breakdown(t: Tables, region: str, month: str) -> DataFrame:
    """Cash-on-delivery orders of one region and month with the typed price calculation."""
    first = F.lit(month).cast("date")
    orders = t["app_order"].filter((F.col("payment_provider") == "cod") & (F.col("region") == region)
                                   & (F.col("created_at") >= first) & (F.col("created_at") < F.add_months(first, 1)))
    price = t["price"].select(F.col("id").alias("price_id"), "product_id")
    product = t["product"].select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    rows = (orders.withColumn("price_id", F.coalesce("prescription_price_id", "price_id"))
            .join(price, "price_id", "left").join(product, "product_id", "left"))
    typed = flatten_variant(rows, "prescription_order_calculation", CALCULATION_FIELDS)
    return typed.select("short_id", "sys_id", F.to_date("created_at").alias("created_date"), "status", "phone_number", "price_id",
                        "product_id", "product_name", F.col("total").alias("total_amount"),
                        *[c for c in CALCULATION_FIELDS if c != "total"], "prescription_order_calculation")


def atome_parsed(t: Tables) -> DataFrame:
    """Instalment payments with their order, typed notification and typed price calculation."""
    order = t["app_order"].select(
        F.col("sys_id").alias("ordersysid"), F.col("short_id").alias("external_platform_id"), F.coalesce("prescription_price_id", "price_id").alias("price_id"),
        F.col("status").alias("order_status"), F.col("updated_by").alias("order_updated_by"),
        F.col("stripe_subscription_id").alias("subscription_id"), "prescription_order_calculation")
    rows = t["atome_payments"].join(order, "ordersysid", "left")
    typed = flatten_variant(flatten_variant(rows, "webhook_payload", PAYLOAD_FIELDS, or_first_element=False),
                         "prescription_order_calculation", CALCULATION_FIELDS)
    return typed.select("external_platform_id", F.to_date("created_at").alias("created_at"), F.to_date("updated_at").alias("updated_at"),
                        "sys_id", "ordersysid", "patientsysid", "price_id", F.col("status").alias("atome_status"), "order_status",
                        "order_updated_by", "subscription_id", "amount", *PAYLOAD_FIELDS, *CALCULATION_FIELDS,
                        "webhook_payload", "prescription_order_calculation")


def refresh_tasks(t: Tables) -> DataFrame:
    """Newest live refresh task per target, with the target's name."""
    live = t["refresh_task"].filter(F.col("deleted").eqNullSafe(False))
    newest = latest_per_key(live.withColumn("_target", F.coalesce("datasource_id", "workbook_id")), ["_target"], ["synced_at"],
                            tie_break=["id"])
    source = t["data_source"].select(F.col("id").alias("datasource_id"), F.col("name").alias("source_name"))
    book = t["workbook"].select(F.col("id").alias("workbook_id"), F.col("name").alias("book_name"))
    kind = F.when(F.col("datasource_id").isNotNull(), "Data Source").when(F.col("workbook_id").isNotNull(), "Workbook")
    return (newest.join(source, "datasource_id", "left").join(book, "workbook_id", "left")
            .select(F.col("id").alias("refresh_task_id"), "datasource_id", "workbook_id", "schedule_next_run_at", kind.alias("type"),
                    F.coalesce("source_name", "book_name").alias("name")))


def order_prescriptions(t: Tables, short_ids: DataFrame) -> DataFrame:
    """Listed orders with a first-order flag and the price's JSON attributes. ``short_ids`` is a one-column frame."""
    listed = t["app_order"].filter("patient_id is not null").join(short_ids.distinct(), "short_id", "left_semi")
    # first orders of the listed patients only
    theirs = t["app_order"].join(listed.select("patient_id").distinct(), "patient_id", "left_semi")
    listed = listed.join(theirs.groupBy("patient_id").agg(F.min("created_at").alias("first_created")), "patient_id")
    sheet = t["price_sheet"].select(F.col("price_id").alias("prescription_price_id"), "product_name",
                                    *[json_scalar("price_metadata", f"$.{k}").alias(k) for k in ("frequency", "dosage", "boxes")])
    patient = t["patient"].select(F.col("sys_id").cast("string").alias("patient_id"), "email")
    first = F.when(F.col("created_at") == F.col("first_created"), "Yes").otherwise("No")
    return (listed.withColumn("patient_id", F.col("patient_id").cast("string")).join(sheet, "prescription_price_id", "left")
            .join(patient, "patient_id", "left")
            .select("short_id", "evaluation_id", "product_name", "frequency", "dosage", "boxes", first.alias("is_first_order"), "email"))


def appointment_latest(t: Tables) -> DataFrame:
    return latest_per_key(t["appointment"], ["id"], ["updated_at"], tie_break=["version_id"])


def user_emails(t: Tables) -> DataFrame:
    return latest_per_key(t["user"], ["email"], ["updated_at"], tie_break=["sys_id"]).select("email", "sys_id", "utm_source")


def all_appointments(t: Tables, sources: DataFrame) -> DataFrame:
    """Consult sessions with order, audit, condition and channel."""
    order = t["app_order"].select(
        F.col("sys_id").alias("order_sys_id"), F.col("short_id").alias("order_short_id"), F.col("status").alias("order_status"),
        F.col("prescription_id").isNotNull().alias("has_prescription"), F.col("stripe_subscription_id").isNotNull().alias("has_subscription"),
        json_scalar("utm", "$.utmSource").alias("raw_source"))
    audit = t["consult_audit"].select(F.col("sys_id").alias("consultation_audit_id"), "consult_type", F.col("status").alias("audit_status"),
                                      F.col("evaluation_id").alias("audit_evaluation_id"))
    label = t["condition_map"].select(F.col("raw_condition").alias("audit_evaluation_id"), "condition")
    source = sources.withColumnRenamed("context_campaign_source", "raw_source")
    rows = (t["consult_session"].join(order, "order_sys_id", "left").join(audit, "consultation_audit_id", "left")
            .join(label, "audit_evaluation_id", "left").join(source, "raw_source", "left"))
    return rows.select(
        "region", F.to_date("created_at").alias("date"), F.col("sys_id").alias("consult_sys_id"), "consultation_session_type",
        "order_short_id", "order_sys_id", "consultation_session_status", "progress_status", "consult_type", "audit_status",
        "audit_evaluation_id", "condition", "order_status", F.coalesce("has_prescription", F.lit(False)).alias("has_prescription"),
        F.coalesce("has_subscription", F.lit(False)).alias("has_subscription"), F.coalesce("channel", "raw_source").alias("utm_source"))


def unpaid_appointments(appointments: DataFrame, as_of, months: int = 3) -> DataFrame:
    """Appointments without a subscription in the last months."""
    since = F.add_months(F.lit(as_of).cast("date"), -months)
    return appointments.filter(F.col("has_subscription").eqNullSafe(False) & (F.col("date") >= since))

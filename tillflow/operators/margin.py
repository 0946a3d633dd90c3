"""Margin arithmetic: inclusive tax, waterfall and signed amounts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import greatest_strict, least_strict, safe_divide


def tax_included(net: Column, rate: Column | str) -> Column:
    """The tax contained in a tax-inclusive amount."""
    r = F.col(rate) if isinstance(rate, str) else rate
    return net * (1 - 1 / (1 + r))


def margin_waterfall(df: DataFrame, zero_missing: bool = True, ebitda: bool = True) -> DataFrame:
    """Gross revenue down to CM2, CM3 and EBITDA.

    Needs amount, refunds, tax_paid_usd, cogs, packaging, delivery_cost, gateway_fees, marketing_cost (and
    operating_expense, staff_cost for EBITDA). ``zero_missing`` counts missing packaging, delivery and gateway
    costs as zero; otherwise a missing cost makes the margins NULL.
    """
    direct = ["packaging", "delivery_cost", "gateway_fees"]
    if zero_missing:
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in direct})
    sales = F.col("amount") - F.col("refunds")
    out = df.withColumns({"net_revenue": sales - F.col("tax_paid_usd"), "gross_profit": sales - F.col("cogs")})
    out = out.withColumn("cm2", F.col("gross_profit") - F.col("packaging") - F.col("delivery_cost")
                         - F.col("gateway_fees"))
    out = out.withColumn("cm3", F.col("cm2") - F.col("marketing_cost"))
    if ebitda:
        out = out.withColumn("ebitda", F.col("cm3") - F.col("operating_expense") - F.col("staff_cost"))
    return out.withColumnRenamed("amount", "gross_revenue")


def positive_part(amount: Column | str) -> Column:
    return greatest_strict(amount, F.lit(0.0))


def negative_part(amount: Column | str) -> Column:
    """Size of the negative part."""
    return F.abs(least_strict(amount, F.lit(0.0)))


def split_signed(df: DataFrame, amount: str, keys: Sequence[str], sale: str = "sale_amount",
                 refund: str = "refund_amount") -> DataFrame:
    """Signed transactions to sales, refunds and refund rate per key; keys without a sale are dropped."""
    sums = df.groupBy(*keys).agg(F.sum(positive_part(amount)).alias(sale), F.sum(negative_part(amount)).alias(refund))
    return sums.filter(F.col(sale) > 0).withColumn("refund_rate", safe_divide(refund, sale))


def pivot_txn(df: DataFrame, keys: Sequence[str], amount: Column, rules: Mapping[str, tuple[Column, int]]
              ) -> DataFrame:
    """Sum typed transactions into columns. A rule is (row test, sign of the amount)."""
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(test, amount * sign).otherwise(F.lit(0.0))).alias(name) for name, (test, sign) in rules.items()])


def kpi_ratios(df: DataFrame) -> DataFrame:
    """CAC, AOV, gross and EBITDA margin where their inputs exist."""
    ratios = {"cac": ("marketing_spend", "n_new_customers"), "aov": ("gross_revenue", "n_orders"),
              "gross_margin": ("gross_profit", "net_revenue"), "ebitda_margin": ("ebitda", "net_revenue")}
    return df.withColumns({name: safe_divide(a, b) for name, (a, b) in ratios.items() if {a, b} <= set(df.columns)})


def period_change(df: DataFrame, month: str, value: str, dims: Sequence[str] = (), months: int = 1,
                  out: str = "change") -> DataFrame:
    """Relative change against the row ``months`` calendar months earlier; NULL when that month is missing."""
    earlier = df.select(*dims, F.add_months(month, months).alias(month), F.col(value).alias("_before"))
    return (df.join(earlier, [*dims, month], "left")
              .withColumn(out, safe_divide(F.col(value) - F.col("_before"), F.col("_before"))).drop("_before"))

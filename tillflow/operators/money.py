"""Currency normalisation: local amounts, minor units and USD."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_rate(df: DataFrame, currency: str, fx: DataFrame, how: str = "left",
              subunits: DataFrame | None = None) -> DataFrame:
    """Add ``fx_to_usd`` (local units per USD) and, when a subunit table is given, ``subunits`` (default 100).

    Both tables hold one row per currency.
    """
    rates = fx.select(F.lower("currency").alias("_fx_ccy"), "fx_to_usd")
    out = df.join(rates, F.lower(F.col(currency)) == F.col("_fx_ccy"), how).drop("_fx_ccy")
    if subunits is not None:
        units = subunits.select(F.lower("currency").alias("_su_ccy"), F.col("subunits").alias("_su"))
        out = (out.join(units, F.lower(F.col(currency)) == F.col("_su_ccy"), "left")
                  .withColumn("subunits", F.coalesce("_su", F.lit(100))).drop("_su_ccy", "_su"))
    return out


def minor_to_usd(amount: Column | str, fx: str = "fx_to_usd", subunits: str | int = "subunits") -> Column:
    """Minor local units to USD, for a frame that went through :func:`with_rate`."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    units = F.lit(subunits) if isinstance(subunits, int) else F.col(subunits)
    return amount / F.col(fx) / units


def to_usd(df: DataFrame, amount: str, currency: str, fx: DataFrame, subunits: DataFrame | None = None,
           minor: bool = True, out: str = "amount_usd") -> DataFrame:
    """Add ``out`` = amount in USD. ``minor`` amounts are divided by the currency's subunits."""
    rated = with_rate(df, currency, fx, subunits=subunits)
    if not minor:
        value = F.col(amount) / F.col("fx_to_usd")
    else:
        value = minor_to_usd(amount, subunits="subunits" if subunits is not None else 100)
    return rated.withColumn(out, value).drop("fx_to_usd", *(["subunits"] if subunits is not None else []))


def to_local(df: DataFrame, amount_usd: str, currency: str, fx: DataFrame, out: str = "amount_local") -> DataFrame:
    return with_rate(df, currency, fx).withColumn(out, F.col(amount_usd) * F.col("fx_to_usd")).drop("fx_to_usd")

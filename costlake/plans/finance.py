"""Invoices: one currency, billing split, monthly revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.functions.rules import billing_rule
from costlake.functions.values import or_zero, round6
from costlake.operators.splits import split


def normalise_billing(invoices: DataFrame) -> DataFrame:
    """Amounts in USD. Missing credits and taxes count as 0, a missing rate as 1."""
    rate = F.coalesce(F.col("exchange_rate_to_usd"), F.lit(1.0))
    return invoices.withColumns(
        {
            "revenue_usd": F.col("subtotal") * rate,
            "credits_usd": or_zero("credits") * rate,
            "taxes_usd": or_zero("taxes") * rate,
            "fx_applied": rate,
        }
    )


def split_billing(invoices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) normalised invoices."""
    return split(normalise_billing(invoices), billing_rule())


def revenue_by_org_month(valid_invoices: DataFrame) -> DataFrame:
    """Net revenue comes from the unrounded sums; rounding is the last step."""
    sums = valid_invoices.groupBy("org_id", "month").agg(
        F.sum("revenue_usd").alias("revenue"),
        F.sum("credits_usd").alias("credits"),
        F.sum("taxes_usd").alias("taxes"),
        F.avg("fx_applied").alias("fx"),
    )
    return sums.select(
        "org_id",
        "month",
        round6("revenue").alias("revenue_usd"),
        round6("credits").alias("credits_usd"),
        round6("taxes").alias("taxes_usd"),
        round6("fx").alias("fx_applied"),
        round6(F.col("revenue") - F.col("credits") + F.col("taxes")).alias("net_revenue_usd"),
    )

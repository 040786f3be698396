"""Serving: row shape of each table and the queries users run on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.functions.values import hash_bucket, round6
from costlake.operators.splits import require_keys
from costlake.sources.schemas import ORG_BUCKETS, SERVING_TABLES, ServingSpec
from costlake.sources.sinks import clustering_order


def _served(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.MapType):
        value_type = field.dataType.valueType
        value = F.transform_values(value, lambda _, count: count.cast(value_type))
    return value.cast(field.dataType).alias(field.name)


def serving_rows(mart: DataFrame, table: str) -> DataFrame:
    """Rows of a serving table: complete keys, declared column order and types."""
    spec = SERVING_TABLES[table]
    if table == "genai_tokens_by_org_date":
        mart = genai_by_key(mart)
    return require_keys(mart, spec.required).select(*[_served(field) for field in spec.schema])


def genai_by_key(mart: DataFrame) -> DataFrame:
    """The token mart has a row per service, the serving key has none: sum instead of overwriting."""
    return mart.groupBy("org_id", "month_bucket", "event_date").agg(
        F.sum("genai_tokens_total").alias("genai_tokens_total"),
        round6(F.sum("estimated_cost_usd")).alias("estimated_cost_usd"),
    )


def _of_org(served: DataFrame, org_id: str) -> DataFrame:
    """Rows of one org. On a stored table the bucket folds to a constant and prunes directories."""
    rows = served.filter(F.col("org_id") == org_id)
    if "org_bucket" in served.columns:
        rows = rows.filter(F.col("org_bucket") == hash_bucket(F.lit(org_id), ORG_BUCKETS))
    return rows


def _in_range(
    served: DataFrame, org_id: str, months: list[str], first_day: str, last_day: str
) -> DataFrame:
    days = F.col("event_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    return _of_org(served, org_id).filter(F.col("month_bucket").isin(months)).filter(days)


def _ordered(rows: DataFrame, spec: ServingSpec) -> DataFrame:
    return rows.orderBy(*clustering_order(spec))


def daily_costs(usage: DataFrame, org_id: str, month: str, first_day: str, last_day: str) -> DataFrame:
    """Q1: cost and requests by day and service."""
    rows = _in_range(usage, org_id, [month], first_day, last_day)
    return _ordered(rows, SERVING_TABLES["org_daily_usage_by_service"]).select(
        "org_id", "month_bucket", "event_date", "service", "daily_cost_usd", "requests"
    )


def top_services(
    usage: DataFrame, org_id: str, months: list[str], first_day: str, last_day: str, n: int = 5
) -> DataFrame:
    """Q2: the n services with the highest total cost, ranked; ties by name."""
    totals = (
        _in_range(usage, org_id, months, first_day, last_day)
        .groupBy("service")
        .agg(round6(F.sum("daily_cost_usd")).alias("total_cost_usd"))
    )
    order = [F.col("total_cost_usd").desc(), F.col("service").asc()]
    top = totals.orderBy(*order).limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"), "service", "total_cost_usd"
    )


def ticket_trend(
    tickets: DataFrame, org_id: str, month: str, first_day: str, last_day: str
) -> DataFrame:
    """Q3: tickets, SLA breaches, CSAT and severities by day."""
    rows = _in_range(tickets, org_id, [month], first_day, last_day)
    return _ordered(rows, SERVING_TABLES["tickets_by_org_date"]).select(
        "event_date", "ticket_count", "sla_breach_rate", "csat_avg", "severity_breakdown"
    )


def monthly_revenue(revenue: DataFrame, org_id: str) -> DataFrame:
    """Q4: revenue, credits, taxes and net by month."""
    spec = SERVING_TABLES["revenue_by_org_month"]
    return _ordered(_of_org(revenue, org_id), spec).select(*spec.columns)


def genai_use(genai: DataFrame, org_id: str, month: str, first_day: str, last_day: str) -> DataFrame:
    """Q5: tokens and estimated cost by day."""
    rows = _in_range(genai, org_id, [month], first_day, last_day)
    return _ordered(rows, SERVING_TABLES["genai_tokens_by_org_date"]).select(
        "org_id", "month_bucket", "event_date", "genai_tokens_total", "estimated_cost_usd"
    )


def cost_anomalies(
    anomalies: DataFrame, org_id: str, month: str, first_day: str, last_day: str
) -> DataFrame:
    """Q6: anomalies by day and service."""
    spec = SERVING_TABLES["cost_anomaly_mart"]
    return _ordered(_in_range(anomalies, org_id, [month], first_day, last_day), spec).select(
        *spec.columns
    )


def preview(rows: DataFrame, limit: int = 20) -> tuple[DataFrame, int]:
    """The first rows of a result for display, and its full row count."""
    return rows.limit(limit), rows.count()

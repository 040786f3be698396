"""Invoices, tickets, orgs and usage events derived from the driver's tables, over all their rows.

The rules hit every branch of the quality checks. ``checks/oracle.py`` states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.plans.ingest import split_landed_events, with_event_columns
from costlake.sources.schemas import BRONZE_EVENT, LANDING_TABLES

JULY_2025 = 1751328000  # 2025-07-01 00:00:00 UTC
BATCH_DATE = "2026-06-15"


def every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def null_every(key: str, n: int, value: Column) -> Column:
    return F.when(~every(key, n), value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing invoice per order. Amounts stay whole cents, so that sums are exact at 6 digits."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    signed = F.when(every("o_orderkey", 20), -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    currency = F.col("o_custkey") % 3
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("invoice_id"),
        null_every("o_orderkey", 101, (F.col("o_custkey") % 50).cast("string")).alias("org_id"),
        F.trunc("o_orderdate", "month").alias("month"),
        null_every("o_orderkey", 37, signed).alias("subtotal"),
        null_every("o_orderkey", 2, F.floor(cents / 20) / 100.0).alias("credits"),
        null_every("o_orderkey", 29, F.floor(cents * 21 / 100) / 100.0).alias("taxes"),
        F.when(currency == 0, "USD").when(currency == 1, "EUR").otherwise("BRL").alias("currency"),
        null_every(
            "o_orderkey", 11, F.when(currency == 0, 1.0).when(currency == 1, 1.1).otherwise(0.2)
        ).alias("exchange_rate_to_usd"),
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing ticket per order."""
    key = F.col("o_orderkey")
    opened = JULY_2025 + (key % 30) * 86400 + (key % 24) * 3600
    severity = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "critical")
        .when(F.col("o_orderpriority") == "2-HIGH", "high")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "medium")
        .when(F.col("o_orderpriority") == "5-LOW", "low")
        .otherwise("unknown")
    )
    return table(spark, sf_dir, "orders").select(
        null_every("o_orderkey", 211, key.cast("string")).alias("ticket_id"),
        (F.col("o_custkey") % 20).cast("string").alias("org_id"),
        F.col("o_orderstatus").alias("category"),
        null_every("o_orderkey", 41, severity).alias("severity"),
        F.timestamp_seconds(opened).alias("created_at"),
        null_every("o_orderkey", 9, F.timestamp_seconds(opened + 7200)).alias("resolved_at"),
        null_every("o_orderkey", 8, (key % 8).cast("double")).alias("csat"),
        null_every("o_orderkey", 13, F.col("o_orderstatus") == "F").alias("sla_breached"),
    )


def customer_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as an org, loaded on two dates; the plan tier differs between the loads."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    tiers = F.array(*[F.lit(t) for t in ["free", "pro", "business", "enterprise"]])
    orgs = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (key + 2).cast("string").alias("org_id"),
            F.col("c_name").alias("org_name"),
            F.col("c_mktsegment").alias("industry"),
            F.col("r_name").alias("hq_region"),
            F.get(tiers, key % 4).alias("plan_tier"),
            (F.col("c_acctbal") > 5000).alias("is_enterprise"),
            F.when(every("c_custkey", 7), "churned").otherwise("active").alias("lifecycle_stage"),
        )
    )
    earlier = orgs.withColumn("plan_tier", F.lit("trial")).withColumn(
        "load_date", F.lit("2026-06-14").cast("date")
    )
    return earlier.unionByName(orgs.withColumn("load_date", F.lit(BATCH_DATE).cast("date")))


def landing_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five landing tables beside invoices and tickets: some keys are missing, some rows come twice."""
    customer, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    org = (F.col("user_id") % 20).cast("string")
    found = {
        "customers_orgs": customer.select(
            null_every("c_custkey", 13, (F.col("c_custkey") % 700).cast("string")).alias("org_id"),
            F.col("c_name").alias("org_name"), F.col("c_mktsegment").alias("industry"),
        ),
        "marketing_touches": events.select(
            F.col("event_id").cast("string").alias("touch_id"), null_every("event_id", 71, org).alias("org_id"),
            null_every("event_id", 17, F.col("ts")).cast("timestamp").alias("timestamp"),
            (F.col("event_type") == "click").alias("clicked"),
        ),
        "nps_surveys": orders.select(
            (F.col("o_custkey") % 50).cast("string").alias("org_id"),
            null_every("o_orderkey", 19, F.col("o_orderdate").cast("date")).alias("survey_date"),
            (F.col("o_custkey") % 11).cast("double").alias("nps_score"),
        ),
        "resources": part.select(
            F.col("p_partkey").cast("string").alias("resource_id"),
            null_every("p_partkey", 9, F.col("p_brand")).alias("org_id"), F.col("p_type").alias("service"),
        ),
        "users": customer.select(
            F.col("c_custkey").cast("string").alias("user_id"),
            null_every("c_custkey", 8, F.col("c_mktsegment")).alias("org_id"),
            (F.col("c_acctbal") > 0).alias("active"),
        ),
    }
    return {
        name: rows.select(
            *[
                F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in LANDING_TABLES[name].schema
            ]
        )
        for name, rows in found.items()
    }


LANDED_FIELDS = {
    "event_id": "CASE WHEN event_id % 61 <> 0 THEN CAST(event_id AS STRING) END",
    "timestamp": """CASE WHEN event_id % 89 = 0 THEN 'not-a-time'
        ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') END""",
    "org_id": "CASE WHEN event_id % 71 <> 0 THEN CAST(user_id % 20 AS STRING) END",
    "service": "CASE WHEN event_type = 'click' THEN 'genai' ELSE event_type END",
    "region": "concat('region-', user_id % 3)",
    "resource_id": "concat('res-', user_id)",
    "metric": "element_at(array(' Requests ', 'CPU_Hours', 'storage_gb_hours '), int(event_id % 3 + 1))",
    "value": """CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'bad'
        ELSE CAST(value AS STRING) END""",
    "unit": """CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 53 = 0 THEN ' '
        ELSE element_at(array('count', ' hours', 'gb_hours'), int(event_id % 3 + 1)) END""",
    "cost_usd_increment": "CASE WHEN event_id % 47 <> 0 THEN value / 10 - 0.5D END",
    "schema_version": "CASE WHEN event_id % 2 = 1 THEN 2 ELSE 1 END",
    "genai_tokens": """CASE WHEN event_id % 2 = 1 AND event_type IN ('click', 'purchase')
        THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END""",
    "carbon_kg": "CASE WHEN event_id % 2 = 1 THEN value / 1000 END",
}


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed event per row of ``events``; some lines are corrupt and carry only their text."""
    readable = [f"IF(event_id % 83 <> 0, {rule}, NULL) AS {name}" for name, rule in LANDED_FIELDS.items()]
    return table(spark, sf_dir, "events").selectExpr(
        *readable,
        "IF(event_id % 83 = 0, concat('{bad json ', event_id), NULL) AS _corrupt_record",
        "'events' AS source_file",
    )


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as text lines."""
    line = F.coalesce("_corrupt_record", F.to_json(F.struct(*LANDED_FIELDS)))
    return landed_events(spark, sf_dir).select(line.alias("value"))


def with_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_columns(landed_events(spark, sf_dir))


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events in bronze form; ids are unique in the source."""
    valid, _ = split_landed_events(with_times(spark, sf_dir))
    return valid.select(*BRONZE_EVENT.fieldNames())

"""Fixed, all-nullable schemas of landing files, bronze events and silver features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "STRINGS": T.ArrayType(T.StringType()),
    "INT_MAP": T.MapType(T.StringType(), T.IntegerType()),
    "BIGINT_MAP": T.MapType(T.StringType(), T.LongType()),
}


def typed(text: str) -> T.StructType:
    """Schema from ``name TYPE`` pairs. Spark's own DDL reader needs a running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class TableSpec:
    """A landing table: its file, schema, natural key, partition column and required columns."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    partition_by: str
    required: tuple[str, ...]

    @property
    def file(self) -> str:
        return f"{self.name}.csv"

    @property
    def may_move(self) -> bool:
        """Whether a row that lands again can belong to another partition. Loads kept by their date are history,
        and a partition column that is part of the key names another row."""
        return self.partition_by not in (*self.keys, "load_date", "batch_date")


# Fixed values of the data contract: column names, types, keys.
LANDING_TABLES = {
    spec.name: spec
    for spec in [
        TableSpec(
            "billing_monthly",
            typed("""invoice_id STRING, org_id STRING, month DATE, subtotal DOUBLE, credits DOUBLE,
                   taxes DOUBLE, currency STRING, exchange_rate_to_usd DOUBLE"""),
            keys=("invoice_id",),
            partition_by="month",
            required=("invoice_id", "org_id", "month"),
        ),
        TableSpec(
            "customers_orgs",
            typed("""org_id STRING, org_name STRING, industry STRING, hq_region STRING,
                   plan_tier STRING, is_enterprise BOOLEAN, signup_date DATE, sales_rep STRING,
                   lifecycle_stage STRING, marketing_source STRING, nps_score DOUBLE"""),
            keys=("org_id",),
            partition_by="load_date",
            required=("org_id",),
        ),
        TableSpec(
            "marketing_touches",
            typed("""touch_id STRING, org_id STRING, campaign STRING, channel STRING,
                   timestamp TIMESTAMP, clicked BOOLEAN, converted BOOLEAN"""),
            keys=("touch_id",),
            partition_by="touch_date",
            required=("touch_id", "org_id", "touch_date"),
        ),
        TableSpec(
            "nps_surveys",
            typed("org_id STRING, survey_date DATE, nps_score DOUBLE, comment STRING"),
            keys=("org_id", "survey_date"),
            partition_by="survey_date",
            required=("org_id", "survey_date"),
        ),
        TableSpec(
            "resources",
            typed("""resource_id STRING, org_id STRING, service STRING, region STRING,
                   created_at TIMESTAMP, state STRING, tags_json STRING"""),
            keys=("resource_id",),
            partition_by="batch_date",
            required=("resource_id", "org_id"),
        ),
        TableSpec(
            "support_tickets",
            typed("""ticket_id STRING, org_id STRING, category STRING, severity STRING,
                   created_at TIMESTAMP, resolved_at TIMESTAMP, csat DOUBLE,
                   sla_breached BOOLEAN"""),
            keys=("ticket_id",),
            partition_by="created_date",
            required=("ticket_id", "org_id", "created_date"),
        ),
        TableSpec(
            "users",
            typed("""user_id STRING, org_id STRING, email STRING, role STRING, active BOOLEAN,
                   created_at TIMESTAMP, last_login TIMESTAMP"""),
            keys=("user_id",),
            partition_by="load_date",
            required=("user_id", "org_id"),
        ),
    ]
}

# Landed event lines. One schema covers versions 1 and 2; tokens and carbon exist from version 2.
LANDED_EVENT = typed(
    """event_id STRING, timestamp STRING, org_id STRING, service STRING, region STRING,
       resource_id STRING, metric STRING, value STRING, unit STRING, cost_usd_increment DOUBLE,
       schema_version INT, genai_tokens BIGINT, carbon_kg DOUBLE, _corrupt_record STRING"""
)

BRONZE_EVENT = T.StructType(
    LANDED_EVENT.fields
    + typed(
        """ingest_ts TIMESTAMP, source_file STRING, event_ts TIMESTAMP, batch_date DATE,
           value_num DOUBLE, is_value_cast_error BOOLEAN, event_date DATE"""
    ).fields
)

# Events with their quality flags, as quarantined; and as kept in silver, with org attributes.
FLAGGED_EVENT = T.StructType(
    BRONZE_EVENT.fields
    + typed(
        """dq_event_id_not_null BOOLEAN, dq_event_id_unique BOOLEAN, dq_cost_min_threshold BOOLEAN,
           dq_unit_when_value BOOLEAN, anomaly_cost_flag BOOLEAN, dq_violations STRINGS"""
    ).fields
)

SILVER_EVENT = T.StructType(
    FLAGGED_EVENT.fields
    + typed(
        """org_name STRING, industry STRING, plan_tier STRING, lifecycle_stage STRING,
           hq_region STRING, is_enterprise BOOLEAN"""
    ).fields
)

ORG_DIMENSION_COLUMNS = [
    "org_id", "org_name", "industry", "plan_tier", "lifecycle_stage", "hq_region", "is_enterprise",
]

DAILY_FEATURES = typed(
    """org_id STRING, service STRING, daily_cost_usd DOUBLE, requests BIGINT, cpu_hours DOUBLE,
       storage_gb_hours DOUBLE, genai_tokens_total BIGINT, carbon_kg_total DOUBLE,
       events_count BIGINT, anomaly_events_count BIGINT, event_date DATE, z_score DOUBLE,
       anomaly_zscore_flag BOOLEAN"""
)

# Per service and UTC day, over all of bronze: how many orgs have a cost, its mean, and the sum of squared
# distances from that mean; ``files_until`` is the newest file time known when the day was computed.
DAY_MOMENTS = typed(
    """service STRING, orgs BIGINT, mean_cost DOUBLE, squares DOUBLE, files_until BIGINT, event_date DATE"""
)


@dataclass(frozen=True)
class ServingSpec:
    """A serving table: columns in declared order, partition key, clustering order, bucket layout.

    ``directories`` are the directory levels of its Parquet form, always ending in ``org_bucket``.
    """

    name: str
    schema: T.StructType
    partition_key: tuple[str, ...]
    clustering: tuple[tuple[str, str], ...]
    directories: tuple[str, ...]

    @property
    def primary_key(self) -> list[str]:
        return [*self.partition_key, *[column for column, _ in self.clustering]]

    @property
    def required(self) -> list[str]:
        """Key parts without which a row is not served; ``service`` may be NULL."""
        return [column for column in self.primary_key if column != "service"]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# A year of a mart then has 192 directories; fixed once tables exist.
ORG_BUCKETS = 16
BY_DAY = (("event_date", "desc"),)
BY_DAY_AND_SERVICE = (("event_date", "desc"), ("service", "asc"))

SERVING_TABLES = {
    spec.name: spec
    for spec in [
        ServingSpec(
            "org_daily_usage_by_service",
            typed("""org_id STRING, month_bucket STRING, event_date DATE, service STRING,
                   daily_cost_usd DOUBLE, requests BIGINT, cpu_hours DOUBLE,
                   storage_gb_hours DOUBLE, genai_tokens_total BIGINT, carbon_kg_total DOUBLE,
                   events_count BIGINT, anomaly_events_count BIGINT, quality_score DOUBLE"""),
            ("org_id", "month_bucket"),
            BY_DAY_AND_SERVICE,
            ("month_bucket", "org_bucket"),
        ),
        ServingSpec(
            "revenue_by_org_month",
            typed("""org_id STRING, month STRING, revenue_usd DOUBLE, credits_usd DOUBLE,
                   taxes_usd DOUBLE, net_revenue_usd DOUBLE, fx_applied DOUBLE"""),
            ("org_id",),
            (("month", "desc"),),
            ("org_bucket",),
        ),
        ServingSpec(
            "tickets_by_org_date",
            typed("""org_id STRING, month_bucket STRING, event_date DATE, ticket_count BIGINT,
                   sla_breach_rate DOUBLE, csat_avg DOUBLE, severity_breakdown INT_MAP"""),
            ("org_id", "month_bucket"),
            BY_DAY,
            ("month_bucket", "org_bucket"),
        ),
        ServingSpec(
            "genai_tokens_by_org_date",
            typed("""org_id STRING, month_bucket STRING, event_date DATE,
                   genai_tokens_total BIGINT, estimated_cost_usd DOUBLE"""),
            ("org_id", "month_bucket"),
            BY_DAY,
            ("month_bucket", "org_bucket"),
        ),
        ServingSpec(
            "cost_anomaly_mart",
            typed("""org_id STRING, month_bucket STRING, event_date DATE, service STRING,
                   anomaly_events_count BIGINT, events_count BIGINT, quality_score DOUBLE,
                   z_score DOUBLE, anomaly_zscore_flag BOOLEAN"""),
            ("org_id", "month_bucket"),
            BY_DAY_AND_SERVICE,
            ("month_bucket", "org_bucket"),
        ),
    ]
}

# Gold marts as read back from files. ``month`` of the revenue mart is a date directory that is
# served as text; the severity map is narrowed on serving.
GOLD_MARTS = {
    "org_daily_usage_by_service": T.StructType(
        SERVING_TABLES["org_daily_usage_by_service"].schema.fields
        + typed("z_score DOUBLE, anomaly_zscore_flag BOOLEAN").fields
    ),
    "revenue_by_org_month": SERVING_TABLES["revenue_by_org_month"].schema,
    "tickets_by_org_date": typed(
        """org_id STRING, event_date DATE, ticket_count BIGINT, sla_breach_rate DOUBLE,
           csat_avg DOUBLE, severity_breakdown BIGINT_MAP, month_bucket STRING"""
    ),
    "genai_tokens_by_org_date": SERVING_TABLES["genai_tokens_by_org_date"].schema,
    "cost_anomaly_mart": SERVING_TABLES["cost_anomaly_mart"].schema,
}

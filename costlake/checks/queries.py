"""The registered queries: one per operator of the survey, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.checks.views import (
    BATCH_DATE,
    LANDED_FIELDS,
    bronze_events,
    customer_loads,
    every,
    invoices,
    landed_events,
    landed_lines,
    landing_tables,
    table,
    tickets,
    with_times,
)
from costlake.functions.rules import with_event_flags
from costlake.functions.values import round6
from costlake.operators.dedupe import dedupe_rows, dedupe_stream
from costlake.operators.splits import first_rows, require_keys
from costlake.plans import flows, marts, serving
from costlake.plans.finance import revenue_by_org_month, split_billing
from costlake.plans.ingest import (
    ingest,
    ingest_stats,
    split_landed_events,
    to_bronze,
    with_technical_columns,
    with_totals,
)
from costlake.plans.support import split_tickets, tickets_by_org_day, tickets_by_severity
from costlake.plans.usage import (
    conform_events,
    daily_features,
    enrich_events,
    org_dimension,
    service_baseline,
    silver_events,
    split_events,
    with_z_score,
)
from costlake.session import run_folder, shuffle_width, shuffles_of, use_utc
from costlake.sources.keyed import load_keyed
from costlake.sources.readers import (
    dry_run_count,
    read_declared,
    read_landing,
    stream_landed_events,
    stream_parquet,
)
from costlake.sources.schemas import (
    BRONZE_EVENT,
    DAILY_FEATURES,
    GOLD_MARTS,
    LANDING_TABLES,
    SERVING_TABLES,
)
from costlake.sources.sinks import (
    materialise,
    read_serving,
    upsert,
    verify_counts,
    write_partitions,
    write_quarantine,
)
from costlake.sources.storage import total_bytes
from costlake.streaming.counts import dropped_rows
from costlake.streaming.jobs import (
    DELAY,
    await_all,
    features_stream,
    start_append,
    start_bronze,
    start_gold,
    start_quarantine_samples,
    start_serving,
)
from costlake.streaming.late import LATE_EVENT, keep_late

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}
UNPACKED = 4


def register(query: Query, name: str | None = None) -> Query:
    """Register under the function's name; results are comparable and computed in UTC.

    Streams and written tables of a query are shuffled by a width that fits the tables: Parquet
    unpacks to a few times its size. The caller's session keeps its own settings.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        width = shuffle_width(UNPACKED * total_bytes(spark, sf_dir), least=8)
        with shuffles_of(use_utc(spark), width):
            return comparable(query(spark, sf_dir))

    REGISTERED[name or query.__name__] = run
    return query


def comparable(df: DataFrame) -> DataFrame:
    """Doubles at 6 digits and timestamps as text, so that another engine can give equal values."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = round6(column)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    return materialise(df, run_folder(df.sparkSession, purpose))


# --- invoices ---------------------------------------------------------------------------------


@register
def billing_normalized(spark, sf_dir):
    valid, _ = split_billing(invoices(spark, sf_dir))
    return valid


@register
def billing_quarantine(spark, sf_dir):
    """Written and read back; the split keeps rows whose revenue is unknown."""
    _, rejected = split_billing(invoices(spark, sf_dir))
    path = run_folder(spark, "billing-quarantine")
    write_quarantine(rejected, path)
    return read_declared(spark, path, rejected.schema)


def revenue(spark, sf_dir):
    valid, _ = split_billing(invoices(spark, sf_dir))
    return revenue_by_org_month(valid)


@register
def revenue_mart(spark, sf_dir):
    return revenue(spark, sf_dir)


def revenue_with_text_month(spark, sf_dir):
    path = run_folder(spark, "revenue-mart")
    write_partitions(revenue(spark, sf_dir), path, ["month"])
    return read_declared(spark, path, GOLD_MARTS["revenue_by_org_month"])


@register
def revenue_serving_month_text(spark, sf_dir):
    return revenue_with_text_month(spark, sf_dir)


@register
def serving_rows_revenue(spark, sf_dir):
    mart = revenue(spark, sf_dir)
    return serving.serving_rows(mart, "revenue_by_org_month")


@register
def required_key_filter(spark, sf_dir):
    return require_keys(invoices(spark, sf_dir), list(LANDING_TABLES["billing_monthly"].required))


@register
def partition_overwrite_idempotent(spark, sf_dir):
    """Write all months, write them again, then replace the months from 1998 on."""
    valid, _ = split_billing(invoices(spark, sf_dir))
    path = run_folder(spark, "partition-overwrite")
    write_partitions(valid, path, ["month"])
    write_partitions(valid, path, ["month"])
    recent = valid.filter(F.col("month") >= "1998-01-01").withColumn("credits_usd", F.lit(0.0))
    write_partitions(recent, path, ["month"])
    return (
        read_declared(spark, path, valid.schema)
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("invoices"), F.sum("credits_usd").alias("credits_usd"))
    )


@register
def ingest_moved_keys(spark, sf_dir):
    """All invoices, then a second load that brings every seventh invoice, and all of March 1995, twenty years
    later: months lose what moved, one month goes altogether, and each invoice is there once."""
    spec = LANDING_TABLES["billing_monthly"]
    first = require_keys(invoices(spark, sf_dir), list(spec.required))
    again = every("invoice_id", 7) | (F.col("month") == "1995-03-01")
    later = first.filter(again).withColumn("month", F.add_months("month", 240))
    path = run_folder(spark, "moved-keys")
    for load in (first, later, later):
        load_keyed(load, path, list(spec.keys), spec.partition_by)
    return read_declared(spark, path, first.schema)


def invoices_landed_twice(spark, sf_dir):
    once = invoices(spark, sf_dir)
    return once.unionByName(once)


@register
def ingest_csv_roundtrip(spark, sf_dir):
    """Invoices as a landing CSV file with some unreadable amounts, then through the ingest steps."""
    root = run_folder(spark, "landing")
    rows = invoices_landed_twice(spark, sf_dir)
    amount = F.col("subtotal").cast("string")
    text = rows.withColumn(
        "subtotal", F.when(every("invoice_id", 17), "n/a").otherwise(amount)
    )
    spec = LANDING_TABLES["billing_monthly"]
    text.write.option("header", True).csv(f"{root}/{spec.file}")
    landed = with_technical_columns(read_landing(spark, spec, root), BATCH_DATE)
    return to_bronze(landed, spec).select(
        *spec.schema.fieldNames(),
        "batch_date",
        "load_date",
        F.col("source_file").isNotNull().alias("has_source_file"),
    )


# --- ingest -----------------------------------------------------------------------------------


@register
def ingest_landing_tables(spark, sf_dir):
    """The other five landing tables as CSV files through the whole ingest: its statistics, and the rows that a dry
    run then reads under the declared schema."""
    root = run_folder(spark, "landing-tables")
    tables = landing_tables(spark, sf_dir)
    for name, rows in tables.items():
        rows.unionByName(rows).write.option("header", True).csv(f"{root}/landing/{LANDING_TABLES[name].file}")
    stats = ingest(spark, f"{root}/landing", f"{root}/bronze", BATCH_DATE, ",".join(tables))
    read = [
        (name, dry_run_count(spark, f"{root}/bronze/batch/{name}", LANDING_TABLES[name].schema)) for name in tables
    ]
    return stats.join(spark.createDataFrame(read, "table_name string, dry_run_rows long"), "table_name", "left")


@register
def revenue_preview(spark, sf_dir):
    """The first rows for display, and how many there are."""
    rows, total = serving.preview(revenue(spark, sf_dir).orderBy("org_id", "month"))
    return rows.withColumn("total_rows", F.lit(total).cast("long"))


def landed_tickets(spark, sf_dir):
    return with_technical_columns(tickets(spark, sf_dir), BATCH_DATE)


@register
def bronze_technical_columns(spark, sf_dir):
    """Tickets written as a landing file and scanned, so that each row has its source file."""
    root = run_folder(spark, "landing")
    spec = LANDING_TABLES["support_tickets"]
    tickets(spark, sf_dir).write.option("header", True).csv(f"{root}/{spec.file}")
    return with_technical_columns(read_landing(spark, spec, root), BATCH_DATE).select(
        "ticket_id",
        "created_date",
        "batch_date",
        "load_date",
        F.col("source_file").isNotNull().alias("has_source_file"),
        F.col("ingest_ts").isNotNull().alias("has_ingest_ts"),
    )


def run_stats(spark, sf_dir):
    return with_totals(
        [
            ingest_stats(invoices_landed_twice(spark, sf_dir), LANDING_TABLES["billing_monthly"]),
            ingest_stats(landed_tickets(spark, sf_dir), LANDING_TABLES["support_tickets"]),
        ]
    )


register(run_stats, "ingest_stats")


@register
def dedupe_natural_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    order = [F.col(name).asc() for name in lines.columns if name not in keys]
    return dedupe_rows(lines, keys, order)


# --- tickets ----------------------------------------------------------------------------------


@register
def tickets_valid(spark, sf_dir):
    valid, _ = split_tickets(tickets(spark, sf_dir))
    return valid


@register
def tickets_quarantine(spark, sf_dir):
    _, rejected = split_tickets(tickets(spark, sf_dir))
    path = run_folder(spark, "tickets-quarantine")
    write_quarantine(rejected, path)
    return read_declared(spark, path, rejected.schema)


def by_severity(spark, sf_dir):
    valid, _ = split_tickets(tickets(spark, sf_dir))
    return tickets_by_severity(valid)


def ticket_days(spark, sf_dir):
    return tickets_by_org_day(by_severity(spark, sf_dir))


def with_severity_columns(rows: DataFrame) -> DataFrame:
    counts = {
        f"{name}_count": F.element_at("severity_breakdown", name).cast("long")
        for name in ["low", "medium", "high", "critical"]
    }
    return rows.withColumns(counts).drop("severity_breakdown")


@register
def tickets_daily_by_severity(spark, sf_dir):
    return by_severity(spark, sf_dir)


@register
def tickets_mart(spark, sf_dir):
    return with_severity_columns(ticket_days(spark, sf_dir))


@register
def tickets_severity_map(spark, sf_dir):
    return ticket_days(spark, sf_dir).select(
        "org_id", "event_date", F.explode("severity_breakdown").alias("severity", "tickets")
    )


@register
def serving_rows_tickets(spark, sf_dir):
    return with_severity_columns(
        serving.serving_rows(ticket_days(spark, sf_dir), "tickets_by_org_date")
    )


# --- usage events -----------------------------------------------------------------------------


@register
def events_cast_errors(spark, sf_dir):
    return with_times(spark, sf_dir).select(
        "event_id", "timestamp", "event_ts", "event_date", "value", "value_num", "is_value_cast_error"
    )


BRONZE_KEPT = [
    "event_id", "org_id", "service", "metric", "value", "unit", "value_num", "event_ts", "event_date",
]


@register
def events_valid(spark, sf_dir):
    return bronze_events(spark, sf_dir).select(*BRONZE_KEPT)


@register
def events_invalid(spark, sf_dir):
    _, invalid = split_landed_events(with_times(spark, sf_dir))
    return invalid.select(*BRONZE_KEPT, "_corrupt_record", "is_value_cast_error")


@register
def events_conformed(spark, sf_dir):
    return conform_events(bronze_events(spark, sf_dir)).select(
        "event_id", "event_ts", "event_date", "metric", "unit", "value_num", "cost_usd_increment",
        "genai_tokens", "carbon_kg",
    )


FLAGS = [
    "dq_event_id_not_null", "dq_event_id_unique", "dq_cost_min_threshold", "dq_unit_when_value",
    "anomaly_cost_flag",
]


def flagged(spark, sf_dir):
    return with_event_flags(conform_events(bronze_events(spark, sf_dir)))


@register
def events_dq_flags(spark, sf_dir):
    return flagged(spark, sf_dir).select("event_id", *FLAGS)


@register
def events_dq_violations(spark, sf_dir):
    return flagged(spark, sf_dir).select(
        "event_id",
        F.array_join("dq_violations", ",").alias("violations"),
        F.size("dq_violations").cast("long").alias("violation_count"),
    )


@register
def events_quarantine(spark, sf_dir):
    _, rejected = split_events(bronze_events(spark, sf_dir))
    return rejected.select("event_id", "org_id", "service", "value_num", "unit", "event_date")


@register
def quarantine_sample(spark, sf_dir):
    _, rejected = split_events(bronze_events(spark, sf_dir))
    return first_rows(rejected.select("event_id", "org_id", "service", "unit"), 100, ["event_id"])


@register
def events_distinct_ids(spark, sf_dir):
    landed = landed_events(spark, sf_dir)
    return landed.unionByName(landed).agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_distinct("event_id").alias("distinct_ids")
    )


def orgs(spark, sf_dir):
    return org_dimension(customer_loads(spark, sf_dir))


register(orgs, "org_dimension")

ENRICHED = [
    "event_id", "org_id", "org_name", "industry", "plan_tier", "lifecycle_stage", "hq_region",
    "is_enterprise", "service", "cost_usd_increment", "anomaly_cost_flag", "event_date",
]


@register
def events_enriched(spark, sf_dir):
    dimension = stored(orgs(spark, sf_dir), "orgs")
    silver = silver_events(bronze_events(spark, sf_dir))
    return enrich_events(silver, dimension).select(*ENRICHED)


def baseline(spark, sf_dir):
    return service_baseline(bronze_events(spark, sf_dir))


@register
def service_cost_baseline(spark, sf_dir):
    return baseline(spark, sf_dir)


def features(spark, sf_dir):
    return daily_features(silver_events(bronze_events(spark, sf_dir)))


def scored(spark, sf_dir):
    return with_z_score(features(spark, sf_dir), stored(baseline(spark, sf_dir), "baseline"))


def unscored_usage(spark, sf_dir):
    """The usage mart for uses that read no z-score: saves the pass over history for the baseline."""
    return marts.usage_mart(
        features(spark, sf_dir)
        .withColumn("z_score", F.lit(None).cast("double"))
        .withColumn("anomaly_zscore_flag", F.lit(None).cast("boolean"))
    )


@register
def features_org_daily(spark, sf_dir):
    return scored(spark, sf_dir)


@register
def cost_zscore_anomalies(spark, sf_dir):
    return scored(spark, sf_dir).filter("anomaly_zscore_flag").select(
        "event_date", "org_id", "service", "daily_cost_usd", "z_score"
    )


@register
def gold_usage_mart(spark, sf_dir):
    return marts.usage_mart(scored(spark, sf_dir))


@register
def gold_genai_tokens(spark, sf_dir):
    return marts.genai_mart(unscored_usage(spark, sf_dir))


@register
def gold_cost_anomaly(spark, sf_dir):
    return marts.anomaly_mart(marts.usage_mart(scored(spark, sf_dir)))


@register
def serving_rows_usage(spark, sf_dir):
    return serving.serving_rows(unscored_usage(spark, sf_dir), "org_daily_usage_by_service")


@register
def serving_rows_genai(spark, sf_dir):
    mart = marts.genai_mart(unscored_usage(spark, sf_dir))
    return serving.serving_rows(mart, "genai_tokens_by_org_date")


@register
def serving_rows_anomaly(spark, sf_dir):
    mart = marts.anomaly_mart(marts.usage_mart(scored(spark, sf_dir)))
    return serving.serving_rows(mart, "cost_anomaly_mart")


# --- serving queries --------------------------------------------------------------------------

ORG, MONTH, FIRST_DAY, LAST_DAY = "3", "2024-01", "2024-01-05", "2024-01-25"

MART_OF_TABLE: dict[str, Query] = {
    "org_daily_usage_by_service": unscored_usage,
    "revenue_by_org_month": revenue,
    "tickets_by_org_date": ticket_days,
    "genai_tokens_by_org_date": lambda *at: marts.genai_mart(unscored_usage(*at)),
    "cost_anomaly_mart": lambda *at: marts.anomaly_mart(marts.usage_mart(scored(*at))),
}


def served(spark, sf_dir, name):
    """A serving table, published from the given tables and then only read, as users do."""
    path = run_folder(spark, f"serving-{name}")
    upsert(serving.serving_rows(MART_OF_TABLE[name](spark, sf_dir), name), SERVING_TABLES[name], path)
    return read_serving(spark, SERVING_TABLES[name], path)


@register
def serving_q1_daily_costs(spark, sf_dir):
    rows = served(spark, sf_dir, "org_daily_usage_by_service")
    return serving.daily_costs(rows, ORG, MONTH, FIRST_DAY, LAST_DAY)


@register
def serving_q2_top_services(spark, sf_dir):
    rows = served(spark, sf_dir, "org_daily_usage_by_service")
    months = ["2023-12", MONTH]
    return serving.top_services(rows, ORG, months, "2024-01-10", "2024-01-23", n=3)


@register
def serving_q3_tickets_sla(spark, sf_dir):
    rows = served(spark, sf_dir, "tickets_by_org_date")
    return with_severity_columns(
        serving.ticket_trend(rows, "3", "2025-07", "2025-07-01", "2025-07-31")
    )


@register
def serving_q4_revenue(spark, sf_dir):
    return serving.monthly_revenue(served(spark, sf_dir, "revenue_by_org_month"), "7")


@register
def serving_q5_genai(spark, sf_dir):
    rows = served(spark, sf_dir, "genai_tokens_by_org_date")
    return serving.genai_use(rows, ORG, MONTH, FIRST_DAY, LAST_DAY)


@register
def serving_q6_anomalies(spark, sf_dir):
    rows = served(spark, sf_dir, "cost_anomaly_mart")
    return serving.cost_anomalies(rows, ORG, MONTH, FIRST_DAY, LAST_DAY)


@register
def serving_upsert_usage(spark, sf_dir):
    """All usage rows, then the days from the 15th on again with their cost set to zero."""
    spec = SERVING_TABLES["org_daily_usage_by_service"]
    rows = stored(serving_rows_usage(spark, sf_dir), "usage-rows")
    path = run_folder(spark, "serving-usage")
    upsert(rows, spec, path)
    update = rows.filter(F.col("event_date") >= "2024-01-15").withColumn("daily_cost_usd", F.lit(0.0))
    upsert(update, spec, path)
    return read_serving(spark, spec, path).drop("org_bucket")


# --- streams ----------------------------------------------------------------------------------
# Registered streams set no bound on files per micro-batch: which rows are late then depends on the
# events alone and not on the order in which the files of a run became visible.


def read_back(spark, path, schema, kept):
    return read_declared(spark, path, schema).select(*kept)


def bronze_source(spark, sf_dir, root):
    """Bronze events as a Parquet folder to stream from."""
    path = f"{root}/source"
    bronze_events(spark, sf_dir).write.mode("append").parquet(path)
    return path


@register
def stream_bronze_events(spark, sf_dir):
    """Landed lines, each in two files, through watermark and dedupe into bronze."""
    root = run_folder(spark, "stream-bronze")
    for copy in ("a", "b"):
        landed_lines(spark, sf_dir).write.text(f"{root}/landing/{copy}")
    lines = stream_landed_events(spark, f"{root}/landing/*", None, "*.txt")
    await_all(start_bronze(lines, f"{root}/bronze", f"{root}/checkpoints"))
    return read_back(spark, f"{root}/bronze/streaming/usage_events", BRONZE_EVENT, BRONZE_KEPT)


@register
def stream_rows_accounted(spark, sf_dir):
    """Landed lines, each in two files, with a bound on files per micro-batch. Which rows are late then
    depends on the order of the files, but kept, rejected, late and doubled rows are all there are."""
    root = run_folder(spark, "stream-accounted")
    for copy in ("a", "b"):
        landed_lines(spark, sf_dir).repartition(3).write.text(f"{root}/landing/{copy}")
    lines = stream_landed_events(spark, f"{root}/landing/*", 2, "*.txt")
    with dropped_rows(spark) as dropped:
        left_out = dropped.of(await_all(start_bronze(lines, f"{root}/bronze", f"{root}/checkpoints")))
    tables = {
        "kept": f"{root}/bronze/streaming/usage_events",
        "rejected": f"{root}/bronze/quarantine/usage_events_invalid",
    }
    return verify_counts(spark, tables).agg(
        (F.coalesce(F.sum("total_rows"), F.lit(0)) + F.lit(sum(left_out))).alias("rows_accounted")
    )


#: Lines of a landing file of ``landed_backwards`` at most, or nearly so: some 100 MB.
LANDED_FILE_LINES = 250_000


def landed_backwards(spark, sf_dir, root, file_lines=LANDED_FILE_LINES):
    """Landed lines in four parts, the newest events in the first, and all of them once more. Each part is as many
    files as its lines need, so that no task reads or writes a whole part; returns the path and that number.

    The bounds between the parts are approximate quantiles, for which no task sees all times."""
    lines = landed_events(spark, sf_dir).select(
        F.coalesce("_corrupt_record", F.to_json(F.struct(*LANDED_FIELDS))).alias("value"),
        F.coalesce(F.try_to_timestamp("timestamp"), F.lit("2024-01-01").cast("timestamp")).alias("at"),
    )
    lines = stored(lines, "landed-lines")
    quarters, total = lines.agg(
        F.percentile_approx(F.unix_micros("at"), [0.25, 0.5, 0.75], 1000), F.count(F.lit(1))
    ).first()
    files = max(1, -(-total // (4 * file_lines)))
    bounds = [None, *sorted(quarters, reverse=True), None]
    at = F.unix_micros("at")
    for copy in ("a", "b"):
        for i, (above, below) in enumerate(zip(bounds[1:], bounds)):
            part = lines.filter(at >= above if above is not None else F.lit(True))
            part = part.filter(at < below if below is not None else F.lit(True))
            part.select("value").repartition(files).write.text(f"{root}/landing/{copy}{i}")
    return f"{root}/landing/*", files


@register
def stream_late_rows_kept(spark, sf_dir):
    """Landed lines, newest files first and each twice, with one part per micro-batch: most parts come late. Every valid
    event is in bronze or among the late rows, and each line is kept, rejected, late or a copy."""
    root = run_folder(spark, "stream-late-rows")
    path, files = landed_backwards(spark, sf_dir, root)
    lines = stream_landed_events(spark, path, files, "*.txt")
    with dropped_rows(spark) as dropped:
        reported, copies = dropped.of(await_all(start_bronze(lines, f"{root}/bronze", f"{root}/checkpoints")))
    late_path = f"{root}/late"
    found = keep_late(spark, f"{root}/checkpoints/bronze/usage_events", late_path, DELAY)
    again = keep_late(spark, f"{root}/checkpoints/bronze/usage_events", late_path, DELAY)
    kept = read_declared(spark, f"{root}/bronze/streaming/usage_events", BRONZE_EVENT)
    late = read_declared(spark, late_path, LATE_EVENT)
    rejected = spark.read.parquet(f"{root}/bronze/quarantine/usage_events_invalid")
    counted = kept.count() + rejected.count() + late.count() + copies
    ids = kept.select("event_id", "event_ts").unionByName(late.select("event_id", "event_ts")).distinct()
    return ids.select(
        "event_id", "event_ts", F.lit(found == reported > 0 and not again).alias("late_as_reported"),
        F.lit(counted).cast("long").alias("rows_accounted"),
    )


@register
def stream_continuous(spark, sf_dir):
    """Quality failures of the silver step, by a query that goes on until it is stopped."""
    root = run_folder(spark, "stream-continuous")
    source = bronze_source(spark, sf_dir, root)
    _, rejected = split_events(stream_parquet(spark, source, BRONZE_EVENT))
    query = start_append(rejected, f"{root}/out", f"{root}/checkpoint", "event_date", continuous=True)
    query.processAllAvailable()
    query.stop()
    return read_back(spark, f"{root}/out", rejected.schema, ["event_id", "org_id", "event_date"])


@register
def stream_quarantine(spark, sf_dir):
    """Quality failures of the silver step; as in batch, taken before dedupe."""
    root = run_folder(spark, "stream-quarantine")
    source = bronze_source(spark, sf_dir, root)
    _, rejected = split_events(stream_parquet(spark, source, BRONZE_EVENT))
    start_append(rejected, f"{root}/out", f"{root}/checkpoint", "event_date").awaitTermination()
    kept = ["event_id", "org_id", "service", "value_num", "unit", "event_date"]
    return read_back(spark, f"{root}/out", rejected.schema, kept)


@register
def stream_quarantine_samples(spark, sf_dir):
    root = run_folder(spark, "stream-samples")
    source = bronze_source(spark, sf_dir, root)
    _, rejected = split_events(stream_parquet(spark, source, BRONZE_EVENT))
    start_quarantine_samples(rejected, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    sample = spark.read.schema(rejected.schema).json(f"{root}/out")
    return sample.select(
        "event_id", "event_ts", "org_id", "service", "metric", "value", "unit",
        "cost_usd_increment", F.array_join("dq_violations", ",").alias("violations"),
    )


@register
def stream_dedupe(spark, sf_dir):
    """Every bronze event arrives twice and is kept once."""
    root = run_folder(spark, "stream-dedupe")
    for _ in range(2):
        source = bronze_source(spark, sf_dir, root)
    deduped = dedupe_stream(stream_parquet(spark, source, BRONZE_EVENT), ["event_id"], spread_by="source_file")
    start_append(deduped, f"{root}/out", f"{root}/checkpoint", "event_date").awaitTermination()
    return read_back(spark, f"{root}/out", BRONZE_EVENT, ["event_id", "event_date"])


@register
def stream_events_enriched(spark, sf_dir):
    root = run_folder(spark, "stream-enriched")
    source = bronze_source(spark, sf_dir, root)
    accepted, _ = split_events(stream_parquet(spark, source, BRONZE_EVENT))
    dimension = materialise(orgs(spark, sf_dir), f"{root}/orgs")
    enriched = enrich_events(dedupe_stream(accepted, ["event_id"], spread_by="source_file"), dimension)
    start_append(enriched, f"{root}/out", f"{root}/checkpoint", "event_date").awaitTermination()
    return read_back(spark, f"{root}/out", enriched.schema, ENRICHED)


def streamed_features(spark, sf_dir):
    """Daily features of the closed days, streamed from bronze."""
    root = run_folder(spark, "stream-features")
    source = bronze_source(spark, sf_dir, root)
    accepted, _ = split_events(stream_parquet(spark, source, BRONZE_EVENT))
    history = materialise(
        service_baseline(read_declared(spark, source, BRONZE_EVENT)), f"{root}/baseline"
    )
    result = features_stream(accepted, history)
    start_append(result, f"{root}/out", f"{root}/checkpoint", "event_date").awaitTermination()
    return read_declared(spark, f"{root}/out", DAILY_FEATURES)


@register
def stream_daily_features(spark, sf_dir):
    return streamed_features(spark, sf_dir).drop("z_score", "anomaly_zscore_flag")


@register
def stream_zscore(spark, sf_dir):
    return streamed_features(spark, sf_dir).select(
        "event_date", "org_id", "service", "z_score", "anomaly_zscore_flag"
    )


def streamed_gold(spark, sf_dir):
    root = run_folder(spark, "stream-gold")
    scored(spark, sf_dir).select(*DAILY_FEATURES.fieldNames()).write.parquet(f"{root}/features")
    source = stream_parquet(spark, f"{root}/features", DAILY_FEATURES, 50)
    await_all(start_gold(source, f"{root}/gold", f"{root}/checkpoints"))
    return f"{root}/gold"


@register
def stream_gold_usage(spark, sf_dir):
    name = "org_daily_usage_by_service"
    return read_declared(spark, f"{streamed_gold(spark, sf_dir)}/{name}", GOLD_MARTS[name])


@register
def stream_gold_genai(spark, sf_dir):
    name = "genai_tokens_by_org_date"
    return read_declared(spark, f"{streamed_gold(spark, sf_dir)}/{name}", GOLD_MARTS[name])


@register
def stream_gold_anomaly(spark, sf_dir):
    name = "cost_anomaly_mart"
    return read_declared(spark, f"{streamed_gold(spark, sf_dir)}/{name}", GOLD_MARTS[name])


@register
def stream_gold_marts(spark, sf_dir):
    """Rows of the three marts that one feature stream fans out to."""
    gold = streamed_gold(spark, sf_dir)
    return verify_counts(spark, {name: f"{gold}/{name}" for name in marts.USAGE_MARTS})


@register
def stream_serving_upsert(spark, sf_dir):
    """Two streams into one serving table: rows with a wrong cost, then the same keys corrected."""
    root = run_folder(spark, "stream-serving")
    name = "org_daily_usage_by_service"
    mart = stored(unscored_usage(spark, sf_dir), "usage-mart")
    first = mart.withColumn("daily_cost_usd", F.lit(-1.0))
    for step, rows in enumerate([first, mart]):
        rows.write.parquet(f"{root}/mart{step}")
        stream = stream_parquet(spark, f"{root}/mart{step}", GOLD_MARTS[name])
        start_serving(stream, name, f"{root}/serving", f"{root}/checkpoint{step}").awaitTermination()
    return read_serving(spark, SERVING_TABLES[name], f"{root}/serving").drop("org_bucket")


def dedupe_run(spark, source, root):
    """Start (or restart) the dedupe query on a folder and drain it."""
    deduped = dedupe_stream(stream_parquet(spark, source, BRONZE_EVENT), ["event_id"], spread_by="source_file")
    start_append(deduped, f"{root}/out", f"{root}/checkpoint", "event_date").awaitTermination()


@register
def stream_restart_idempotent(spark, sf_dir):
    """Restarts from the checkpoint: without new files, and with the same events again."""
    root = run_folder(spark, "stream-restart")
    source = bronze_source(spark, sf_dir, root)
    dedupe_run(spark, source, root)
    dedupe_run(spark, source, root)
    bronze_source(spark, sf_dir, root)
    dedupe_run(spark, source, root)
    return read_back(spark, f"{root}/out", BRONZE_EVENT, ["event_id", "event_date"])


@register
def stream_late_data(spark, sf_dir):
    """After all events were seen, the same events come with new ids: those below the watermark
    are dropped, the rest are kept."""
    root = run_folder(spark, "stream-late")
    source = bronze_source(spark, sf_dir, root)
    dedupe_run(spark, source, root)
    bronze_events(spark, sf_dir).withColumn(
        "event_id", F.concat("event_id", F.lit("-late"))
    ).write.mode("append").parquet(source)
    dedupe_run(spark, source, root)
    return read_back(spark, f"{root}/out", BRONZE_EVENT, ["event_id", "event_date"])


# --- flows ------------------------------------------------------------------------------------


def filled(spark, sf_dir, name, run):
    """The lake that a flow fills from the given tables."""
    lake = flows.Lake(run_folder(spark, name))
    run(spark, sf_dir, lake)
    return lake


def fill_streaming(spark, sf_dir, lake, **bounds):
    landed_lines(spark, sf_dir).write.text(f"{lake.root}/landing")
    loads = customer_loads(spark, sf_dir)
    write_partitions(loads, f"{lake.bronze}/batch/customers_orgs", ["load_date"])
    flows.run_streaming(spark, f"{lake.root}/landing", lake, max_files=None, glob="*.txt", **bounds)


def fill_batch(spark, sf_dir, lake):
    sources = {"billing_monthly": invoices_landed_twice, "support_tickets": tickets}
    for name, source in sources.items():
        path = f"{lake.root}/landing/{LANDING_TABLES[name].file}"
        source(spark, sf_dir).write.option("header", True).csv(path)
    flows.run_batch(spark, f"{lake.root}/landing", lake, BATCH_DATE, ",".join(sources))


def served_by(spark, lake, name):
    return read_serving(spark, SERVING_TABLES[name], lake.serving(name)).drop("org_bucket")


@register
def flow_streaming_counts(spark, sf_dir):
    """Landed lines to serving; row counts of every layer."""
    return flows.streaming_counts(spark, filled(spark, sf_dir, "flow-streaming", fill_streaming))


@register
def flow_streaming_usage(spark, sf_dir):
    """The usage table that the same flow serves."""
    lake = filled(spark, sf_dir, "flow-streaming", fill_streaming)
    return served_by(spark, lake, "org_daily_usage_by_service")


@register
def flow_bounded_usage(spark, sf_dir):
    """The same table when silver takes bronze in several micro-batches."""
    bounded = partial(fill_streaming, silver_files=100)
    return served_by(spark, filled(spark, sf_dir, "flow-bounded", bounded), "org_daily_usage_by_service")


@register
def flow_streaming_genai(spark, sf_dir):
    lake = filled(spark, sf_dir, "flow-streaming", fill_streaming)
    return served_by(spark, lake, "genai_tokens_by_org_date")


@register
def flow_streaming_anomaly(spark, sf_dir):
    lake = filled(spark, sf_dir, "flow-streaming", fill_streaming)
    return served_by(spark, lake, "cost_anomaly_mart")


@register
def flow_batch_revenue(spark, sf_dir):
    """Landing CSV files to the served revenue table."""
    lake = filled(spark, sf_dir, "flow-batch", fill_batch)
    return served_by(spark, lake, "revenue_by_org_month")


@register
def flow_batch_tickets(spark, sf_dir):
    """Landing CSV files to the served ticket table. Landing drops tickets without an id."""
    lake = filled(spark, sf_dir, "flow-batch", fill_batch)
    return with_severity_columns(served_by(spark, lake, "tickets_by_org_date"))

"""The batch flow and the streaming flow, end to end: landing, bronze, silver, gold, serving.

Layout below a lake root: ``bronze/batch``, ``bronze/streaming``, ``bronze/quarantine``, ``silver``,
``gold``, ``serving`` and ``checkpoints``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.operators.lookups import keep_directories
from costlake.plans.finance import revenue_by_org_month, split_billing
from costlake.plans.ingest import ingest
from costlake.plans.marts import USAGE_MARTS
from costlake.plans.serving import serving_rows
from costlake.plans.support import split_tickets, tickets_by_org_day, tickets_by_severity
from costlake.plans.usage import baseline_of_moments, day_moments, org_day_costs, org_dimension
from costlake.session import use_utc
from costlake.sources.readers import read_declared, stream_landed_events, stream_parquet
from costlake.sources.schemas import (
    BRONZE_EVENT,
    DAILY_FEATURES,
    DAY_MOMENTS,
    FLAGGED_EVENT,
    GOLD_MARTS,
    SERVING_TABLES,
    SILVER_EVENT,
)
from costlake.sources.sinks import (
    materialise,
    upsert,
    verify_counts,
    write_partitions,
    write_quarantine,
)
from costlake.sources.storage import copy, exists, has_files, names, read_or_empty, remove
from costlake.streaming.counts import dropped_rows
from costlake.streaming.late import keep_late
from costlake.streaming.jobs import (
    DELAY,
    await_all,
    start_bronze,
    start_features,
    start_gold,
    start_quarantine_samples,
    start_serving,
    start_silver,
)


@dataclass(frozen=True)
class Lake:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/checkpoints"

    @property
    def late_events(self) -> str:
        return f"{self.bronze}/quarantine/usage_events_late"

    def serving(self, table: str) -> str:
        return f"{self.root}/serving/{table}"


def batch_silver(spark: SparkSession, lake: Lake) -> None:
    """Billing and tickets of the bronze layer; a table without data is skipped."""
    billing = f"{lake.bronze}/batch/billing_monthly"
    if has_files(spark, billing):
        valid, rejected = split_billing(spark.read.parquet(billing))
        normalised = f"{lake.silver}/billing_monthly_normalized"
        write_partitions(valid, normalised, ["month"], gather=False)  # laid out by month already
        write_quarantine(rejected, f"{lake.silver}/quarantine/billing")
    tickets = f"{lake.bronze}/batch/support_tickets"
    if has_files(spark, tickets):
        valid, rejected = split_tickets(spark.read.parquet(tickets))
        write_partitions(
            tickets_by_severity(valid), f"{lake.silver}/tickets_by_org_date", ["created_date"]
        )
        write_quarantine(rejected, f"{lake.silver}/quarantine/tickets")


def batch_gold(spark: SparkSession, lake: Lake) -> None:
    """Revenue and ticket marts; a missing silver table is skipped."""
    billing = f"{lake.silver}/billing_monthly_normalized"
    if has_files(spark, billing):
        mart = revenue_by_org_month(spark.read.parquet(billing))
        write_partitions(mart, f"{lake.gold}/revenue_by_org_month", ["month"])
    tickets = f"{lake.silver}/tickets_by_org_date"
    if has_files(spark, tickets):
        mart = tickets_by_org_day(spark.read.parquet(tickets))
        write_partitions(mart, f"{lake.gold}/tickets_by_org_date", ["event_date"])


def serve(spark: SparkSession, lake: Lake, table: str) -> bool:
    """Upsert a whole gold mart into its serving table; False if there is no mart yet."""
    mart = f"{lake.gold}/{table}"
    if not has_files(spark, mart):
        return False
    rows = serving_rows(read_declared(spark, mart, GOLD_MARTS[table]), table)
    upsert(rows, SERVING_TABLES[table], lake.serving(table))
    return True


def run_batch(
    spark: SparkSession, landing_root: str, lake: Lake, batch_date: str, tables: str | None = None
) -> DataFrame:
    """Masters, invoices and tickets from landing files to serving; returns the ingest statistics."""
    use_utc(spark)
    stats = ingest(spark, landing_root, lake.bronze, batch_date, tables)
    batch_silver(spark, lake)
    batch_gold(spark, lake)
    for table in ("revenue_by_org_month", "tickets_by_org_date"):
        serve(spark, lake, table)
    return stats


def day_files(spark: SparkSession, path: str, scratch: str) -> DataFrame:
    """(event_date, written): the newest file time, in milliseconds, of every day of the bronze events.

    A stream's sink lists its files, with their times, in a log of its own; no event file is opened for it.
    Spark's readers pass over the log's folder, so its last compacted file and those after it are copied to
    ``scratch``. A table that no stream wrote is asked for its files' times.
    """
    log = f"{path}/_spark_metadata"
    if exists(spark, log):
        number = {name: int(name.split(".")[0]) for name in names(spark, log) if name[0].isdigit()}
        since = max((n for name, n in number.items() if name.endswith(".compact")), default=-1)
        remove(spark, scratch)
        for name, n in number.items():
            if n > since or (n == since and name.endswith(".compact")):
                copy(spark, f"{log}/{name}", f"{scratch}/{name}")
        files = spark.read.schema("path string, modificationTime long, action string").json(scratch)
        day = F.expr("try_cast(regexp_extract(path, 'event_date=([^/]+)', 1) AS date)")
        files = files.filter("action = 'add'").select(day.alias("event_date"), F.col("modificationTime").alias("at"))
    else:
        written = F.unix_millis("_metadata.file_modification_time")
        files = read_declared(spark, path, BRONZE_EVENT).select("event_date", written.alias("at"))
    return files.groupBy("event_date").agg(F.max("at").alias("written"))


def refresh_baseline(spark: SparkSession, lake: Lake) -> DataFrame:
    """Cost baseline over all bronze events, reading only the days that changed.

    Moments per service and day are kept as a table. A day is computed again as a whole, and its old moments
    are replaced, when it is missing there or has a file at least as new as the newest one known when it was
    computed. The baseline then merges a few rows per day instead of reading all events ever seen.
    """
    path = f"{lake.bronze}/streaming/usage_events"
    moments_path = f"{lake.silver}/service_day_moments"
    if has_files(spark, path):
        written = materialise(day_files(spark, path, f"{lake.silver}/bronze_log"), f"{lake.silver}/bronze_days")
        newest = written.agg(F.max("written")).first()[0]
        known = read_or_empty(spark, moments_path, DAY_MOMENTS).groupBy("event_date").agg(
            F.max("files_until").alias("until")
        )
        stale = F.col("until").isNull() | (F.col("written") >= F.col("until"))
        days = written.join(known, "event_date", "left").filter(stale)
        changed = keep_directories(read_declared(spark, path, BRONZE_EVENT), days, ["event_date"])
        moments = day_moments(org_day_costs(changed)).withColumn("files_until", F.lit(newest).cast("long"))
        write_partitions(moments, moments_path, ["event_date"])
    baseline = baseline_of_moments(read_or_empty(spark, moments_path, DAY_MOMENTS))
    return materialise(baseline, f"{lake.silver}/service_baseline")


def run_streaming(
    spark: SparkSession,
    landed_events: str,
    lake: Lake,
    delay: str = DELAY,
    max_files: int | None = 50,
    sample_cap: int | None = None,
    glob: str = "*.jsonl",
    silver_files: int | None = 1000,
) -> DataFrame:
    """Usage events from landing lines to serving, draining each stage; returns its row counts.

    The counts include ``dropped/late`` and ``dropped/copies``: landed events that this run left out
    because they were below the watermark, or equal in id to one that was kept (NULL if Spark's last report of
    a stream does not come). The late ones are kept as rows in ``bronze/quarantine/usage_events_late``. ``max_files`` bounds the
    landing files per micro-batch, ``silver_files`` the bronze files. Bronze removed the copies, so
    silver keeps no state and its bound changes no result. The features read whole micro-batches of
    silver: their files cover several days in no order, and splitting them could make rows late; what
    they hold is one row per org, service and open day. The org dimension and the cost baseline are
    written once per run, so the streams join tables of known size.
    """
    use_utc(spark)
    landed = stream_landed_events(spark, landed_events, max_files, glob)
    with dropped_rows(spark) as dropped:
        _, copies = dropped.of(await_all(start_bronze(landed, lake.bronze, lake.checkpoints, delay)))
    late = keep_late(spark, f"{lake.checkpoints}/bronze/usage_events", lake.late_events, delay)

    customers = spark.read.parquet(f"{lake.bronze}/batch/customers_orgs")
    orgs = materialise(org_dimension(customers), f"{lake.silver}/org_dimension")
    bronze = stream_parquet(spark, f"{lake.bronze}/streaming/usage_events", BRONZE_EVENT, silver_files)
    await_all(start_silver(bronze, orgs, lake.silver, lake.checkpoints, delay, dedupe=False))

    silver = stream_parquet(spark, f"{lake.silver}/events_enriched", SILVER_EVENT)
    rejects = f"{lake.silver}/quarantine"
    quarantined = stream_parquet(spark, f"{rejects}/events_quality_issues", FLAGGED_EVENT)
    baseline = refresh_baseline(spark, lake)
    await_all(
        [
            start_features(silver, baseline, lake.silver, lake.checkpoints, delay),
            start_quarantine_samples(
                quarantined, f"{rejects}/samples", f"{lake.checkpoints}/silver/samples", sample_cap
            ),
        ]
    )

    features = stream_parquet(spark, f"{lake.silver}/features_org_daily", DAILY_FEATURES)
    await_all(start_gold(features, lake.gold, lake.checkpoints))
    await_all([start_table_serving(spark, lake, table) for table in USAGE_MARTS])
    left_out = [("dropped/late", late), ("dropped/copies", copies)]
    counts = streaming_counts(spark, lake)
    return counts.unionByName(spark.createDataFrame(left_out, counts.schema))


def start_table_serving(spark: SparkSession, lake: Lake, table: str, continuous: bool = False):
    """Serving stream of one usage mart; its source has no bound on files per micro-batch."""
    mart = f"{lake.gold}/{table}"
    return start_serving(
        stream_parquet(spark, mart, GOLD_MARTS[table]),
        table,
        lake.serving(table),
        f"{lake.checkpoints}/serving/{table}",
        mart_path=mart if table == "genai_tokens_by_org_date" else None,
        continuous=continuous,
    )


def streaming_counts(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows of every table of the streaming flow, and distinct event ids in silver."""
    enriched = f"{lake.silver}/events_enriched"
    counts = verify_counts(
        spark,
        {
            "bronze/usage_events": f"{lake.bronze}/streaming/usage_events",
            "bronze/usage_events_invalid": f"{lake.bronze}/quarantine/usage_events_invalid",
            "silver/events_enriched": enriched,
            "silver/features_org_daily": f"{lake.silver}/features_org_daily",
            "silver/events_quality_issues": f"{lake.silver}/quarantine/events_quality_issues",
            "gold/org_daily_usage_by_service": f"{lake.gold}/org_daily_usage_by_service",
        },
    )
    if not has_files(spark, enriched):
        return counts
    ids = spark.read.parquet(enriched).agg(
        F.lit("silver/distinct_event_ids").alias("table_name"),
        F.count_distinct("event_id").alias("total_rows"),
    )
    return counts.unionByName(ids)

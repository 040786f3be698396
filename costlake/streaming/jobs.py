"""Structured Streaming jobs. Each starts its queries and returns them; transforms are the batch ones.

A query's checkpoint makes it restartable: a second start goes on where the first ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from costlake.functions.values import hash_bucket
from costlake.operators.dedupe import dedupe_stream
from costlake.operators.lookups import keep_directories
from costlake.operators.splits import first_rows
from costlake.plans.ingest import split_landed_events, with_event_columns
from costlake.plans.marts import USAGE_MARTS, usage_mart
from costlake.plans.serving import serving_rows
from costlake.plans.usage import daily_features, enrich_events, split_events, with_z_score
from costlake.sources.readers import read_declared
from costlake.sources.schemas import (
    DAILY_FEATURES,
    FLAGGED_EVENT,
    GOLD_MARTS,
    SERVING_TABLES,
    SILVER_EVENT,
)
from costlake.sources.sinks import upsert
from costlake.streaming.late import note_start

DELAY = "2 days"
#: Files that one micro-batch writes per directory at most, when its rows come out of a shuffle.
FILES_PER_DIRECTORY = 16
#: JSON keeps times to the microsecond, as the tables do.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
SAMPLE_COLUMNS = [
    "event_id", "event_ts", "org_id", "service", "metric", "value", "unit", "cost_usd_increment",
    "dq_violations", "source_file",
]


def trigger(continuous: bool = False) -> dict:
    """Drain what is there and stop, or look for new files every 30 seconds."""
    return {"processingTime": "30 seconds"} if continuous else {"availableNow": True}


def start_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str | None = None,
    file_format: str = "parquet",
    continuous: bool = False,
) -> StreamingQuery:
    """Append a stream to files, exactly once per checkpoint."""
    writer = (
        stream.writeStream.format(file_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(continuous))
    )
    if file_format == "json":
        writer = writer.option("timestampFormat", JSON_TIME)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.start(path)


def gather(stream: DataFrame, directory: str, item: str, most: int = FILES_PER_DIRECTORY) -> DataFrame:
    """Rows of a directory in at most ``most`` tasks, so that a micro-batch adds at most that many
    files to it. Left as they come out of a stateful step, every state partition would add one.

    Rows are dealt by ``item``, so a day that holds most rows is still written by ``most`` tasks. Raise
    it for a first run over a long history: it bounds the tasks that write one day, not the rows.
    """
    return stream.repartition(F.col(directory), hash_bucket(item, most))


def start_batches(stream: DataFrame, write, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Hand every micro-batch to ``write(batch, batch_id)`` as a static frame."""
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(continuous))
        .start()
    )


def await_all(queries: list[StreamingQuery]) -> list[StreamingQuery]:
    for query in queries:
        query.awaitTermination()
    return queries


def start_bronze(
    landed: DataFrame,
    bronze_root: str,
    checkpoints: str,
    delay: str = DELAY,
    continuous: bool = False,
) -> list[StreamingQuery]:
    """Landed events to bronze (deduped) and to quarantine (as they came)."""
    note_start(landed.sparkSession, f"{checkpoints}/bronze/usage_events")
    valid, invalid = split_landed_events(with_event_columns(landed))
    deduped = dedupe_stream(valid, ["event_id"], delay, spread_by="source_file")
    return [
        start_append(
            gather(deduped, "event_date", "event_id"), f"{bronze_root}/streaming/usage_events", f"{checkpoints}/bronze/usage_events",
            "event_date", continuous=continuous,
        ),
        start_append(
            invalid, f"{bronze_root}/quarantine/usage_events_invalid",
            f"{checkpoints}/bronze/usage_events_invalid", "batch_date", continuous=continuous,
        ),
    ]


def features_stream(accepted: DataFrame, baseline: DataFrame, delay: str = DELAY) -> DataFrame:
    """Dedupe, one-day windows and the z-score lookup in one query, for events that come straight
    from bronze. A day is emitted once it is closed: when the watermark has passed its end."""
    deduped = dedupe_stream(accepted, ["event_id"], delay, spread_by="source_file")
    return with_z_score(daily_features(deduped), baseline)


def start_quarantine_samples(
    quarantined: DataFrame,
    path: str,
    checkpoint: str,
    cap: int | None = None,
    continuous: bool = False,
) -> StreamingQuery:
    """Rejected events as JSON for inspection: all of them, or the first ``cap`` of a micro-batch."""
    sample = quarantined.select(*SAMPLE_COLUMNS)
    if cap is None:
        return start_append(sample, path, checkpoint, file_format="json", continuous=continuous)

    def write(batch: DataFrame, batch_id: int) -> None:
        first_rows(batch, cap, ["event_id", "event_ts", "org_id"]).write.mode("overwrite").json(
            f"{path}/batch={batch_id}", timestampFormat=JSON_TIME
        )

    return start_batches(sample, write, checkpoint, continuous)


def start_silver(
    bronze: DataFrame,
    orgs: DataFrame,
    silver_root: str,
    checkpoints: str,
    delay: str = DELAY,
    continuous: bool = False,
    dedupe: bool = True,
) -> list[StreamingQuery]:
    """Bronze events to enriched events and to quarantine.

    ``orgs`` (one row per org) is static and should be a written table. Without ``dedupe`` the ids are
    taken to be distinct, as ``start_bronze`` leaves them: both queries are then stateless, no row can be
    late, and ``bronze`` may be bounded in any file order.
    """
    accepted, quarantined = split_events(bronze)
    if dedupe:
        accepted = dedupe_stream(accepted, ["event_id"], delay, spread_by="source_file")
    enriched = enrich_events(accepted, orgs)
    return [
        start_append(
            gather(enriched.select(*SILVER_EVENT.fieldNames()), "event_date", "event_id"),
            f"{silver_root}/events_enriched",
            f"{checkpoints}/silver/events_enriched", "event_date", continuous=continuous,
        ),
        start_append(
            quarantined.select(*FLAGGED_EVENT.fieldNames()),
            f"{silver_root}/quarantine/events_quality_issues",
            f"{checkpoints}/silver/events_quality_issues", "event_date", continuous=continuous,
        ),
    ]


def start_features(
    silver: DataFrame,
    baseline: DataFrame,
    silver_root: str,
    checkpoints: str,
    delay: str = DELAY,
    continuous: bool = False,
) -> StreamingQuery:
    """Daily features from a stream over the silver events.

    Those are deduped already, so the events are neither shuffled by id nor kept as dedupe state a
    second time. Read them without a bound on files: the files of one silver micro-batch cover its
    days in no order, and a bound could move the watermark past days that are still unread.
    """
    totals = daily_features(silver.withWatermark("event_ts", delay))
    scored = with_z_score(totals, baseline).select(*DAILY_FEATURES.fieldNames())
    return start_append(
        gather(scored, "event_date", "org_id"),
        f"{silver_root}/features_org_daily", f"{checkpoints}/silver/features_org_daily",
        "event_date", continuous=continuous,
    )


def start_gold(
    features: DataFrame, gold_root: str, checkpoints: str, continuous: bool = False
) -> list[StreamingQuery]:
    """Daily features to the three usage marts, one query each."""
    usage = usage_mart(features)
    return [
        start_append(
            mart(usage), f"{gold_root}/{name}", f"{checkpoints}/gold/{name}",
            "event_date", continuous=continuous,
        )
        for name, mart in USAGE_MARTS.items()
    ]


def start_serving(
    mart: DataFrame,
    table: str,
    path: str,
    checkpoint: str,
    mart_path: str | None = None,
    continuous: bool = False,
) -> StreamingQuery:
    """Upsert a mart stream into its serving table, micro-batch by micro-batch.

    The token mart has several rows per serving key, and they may arrive in different micro-batches.
    With ``mart_path``, the days a micro-batch touches are therefore taken whole from the mart.
    """
    spec = SERVING_TABLES[table]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if mart_path is not None:
            whole_mart = read_declared(batch.sparkSession, mart_path, GOLD_MARTS[table])
            rows = keep_directories(whole_mart, batch, ["event_date"])
        upsert(serving_rows(rows, table), spec, path)

    return start_batches(mart, write, checkpoint, continuous)

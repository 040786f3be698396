"""Rows that a stream left out because they came below its watermark, kept as rows.

A stateful query drops a late row without a trace but a count. What it dropped can be told afterwards: the
query's source log says which landing files were read together, and the watermark follows from the event
times of those read before. Spark tests the rows of a micro-batch against the watermark with which the
micro-batch before it ran: the newest event time of all that came before *that* one, less the delay, in
milliseconds. Where the one before had no rows, or the query had just been started, all earlier rows count.
Empty micro-batches show in the query's offset log, which keeps the last hundred (a run that drains what is
there has none but at its end); starts are noted next to the checkpoint.

``keep_late`` reads the files that it has not seen yet, finds the rows at or below their limit, and writes
them to a table of late rows by micro-batch (numbered as in the source log). A ledger next to that table holds
the newest event time of each micro-batch, so files are read once more and never again. Late rows
are written before the ledger, and by replacing their micro-batches, so a run that dies on the way is
repeated without doubles. The landing files must still be there. After a query that runs on, call it at
least once in a hundred micro-batches.
"""

from __future__ import annotations

import json
import re
from datetime import timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.plans.ingest import split_landed_events, with_event_columns
from costlake.sources.readers import read_landed_events
from costlake.sources.schemas import BRONZE_EVENT
from costlake.sources.sinks import write_partitions
from costlake.sources.storage import exists, has_files, mark, names

BATCH = "late_batch"
LATE_EVENT = T.StructType([*BRONZE_EVENT.fields, T.StructField(BATCH, T.LongType())])
#: ``newest`` in microseconds.
LEDGER = "batch_id long, newest long"


def ledger_path(path: str) -> str:
    return f"{path}__ledger"


def file_batches(spark: SparkSession, checkpoint: str, after: int = -1) -> DataFrame:
    """(path, batch_id) of the files that a query with one file source read after entry ``after`` of its log."""
    log = spark.read.schema("path string, batchId long").json(f"{checkpoint}/sources/0")
    return log.filter(F.col("batchId") > after).select("path", F.col("batchId").alias("batch_id")).distinct()


def one_slash(path: Column) -> Column:
    """Local paths are written with one slash or three; this gives both the same name."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def starts_path(checkpoint: str) -> str:
    return f"{checkpoint}__starts"


def log_offsets(spark: SparkSession, checkpoint: str) -> dict[int, int]:
    """micro-batch -> last entry of the source log that it has read, as far as the offset log goes back."""
    if not exists(spark, f"{checkpoint}/offsets"):
        return {}
    logged = spark.read.text(f"{checkpoint}/offsets", wholetext=True)
    found = logged.select(F.col("_metadata.file_name").alias("name"), "value").collect()
    return {
        int(r["name"]): json.loads(r["value"].strip().split("\n")[-1])["logOffset"] for r in found if r["name"].isdigit()
    }


def note_start(spark: SparkSession, checkpoint: str) -> None:
    """Note, before a query starts, which entry of its source log it will begin with."""
    done = [int(name) for name in names(spark, f"{checkpoint}/commits") if name.isdigit()]
    first = log_offsets(spark, checkpoint)[max(done)] + 1 if done else 0
    mark(spark, f"{starts_path(checkpoint)}/{first}")


def unhurried(spark: SparkSession, checkpoint: str) -> set[int]:
    """The entries of the source log that were read right after a start or an empty micro-batch."""
    at = log_offsets(spark, checkpoint)
    after_empty = {at[n - 1] + 1 for n in at if n - 2 in at and at[n] > at[n - 1] == at[n - 2]}
    return after_empty | {int(name) for name in names(spark, starts_path(checkpoint))}


def late_limits(
    newest: list[tuple[int, int | None]], earlier: int | None, delay: int, unhurried: set[int] = frozenset()
) -> list[tuple[int, int]]:
    """(micro-batch, time at or below which its rows are late), in microseconds; micro-batches without a limit
    are left out. Those of ``unhurried`` are tested against all before them.

    ``newest`` has the newest event time of each micro-batch, ``earlier`` that of all before the first of them but
    the one right before it, which must be in the list itself.
    """
    limits = []
    seen, waiting = earlier, []  # waiting: of micro-batches that are too near to count yet
    for batch, time in sorted(newest, key=lambda item: item[0]):
        while waiting and waiting[0][0] < (batch if batch in unhurried else batch - 1):
            _, held = waiting.pop(0)
            seen = max((t for t in (seen, held) if t is not None), default=None)
        if seen is not None:
            limits.append((batch, seen // 1000 * 1000 - delay))
        waiting.append((batch, time))
    return limits


def keep_late(
    spark: SparkSession, checkpoint: str, path: str, delay: str, most_batches: int = 1000
) -> int:
    """Write the rows that the bronze query with this checkpoint dropped as late to ``path``, by micro-batch;
    returns how many there were in the micro-batches that were new to it. At most ``most_batches`` of those are
    taken at a time."""
    if not exists(spark, f"{checkpoint}/sources/0"):
        return 0
    total = 0
    while True:
        found = _keep_some(spark, checkpoint, path, delay, most_batches)
        if found is None:
            return total
        total += found


def _keep_some(spark: SparkSession, checkpoint: str, path: str, delay: str, most: int) -> int | None:
    ledger = ledger_path(path)
    known, covered, earlier = [], -1, None
    if has_files(spark, ledger):
        seen = spark.read.schema(LEDGER).parquet(ledger)
        covered = seen.agg(F.max("batch_id")).first()[0]
        # Only the last micro-batch may still be too near to count for the next one.
        last = F.col("batch_id") == covered
        known = [(covered, seen.filter(last).agg(F.max("newest")).first()[0])]
        earlier = seen.filter(~last).agg(F.max("newest")).first()[0]
    files = file_batches(spark, checkpoint, covered)
    batches = [r["batch_id"] for r in files.select("batch_id").distinct().orderBy("batch_id").limit(most).collect()]
    if not batches:
        return None
    files = files.filter(F.col("batch_id") <= batches[-1])
    # The log keeps encoded names, the reader takes plain ones and would read some characters as patterns.
    paths = [re.sub(r"([\[\]{}*?,\\])", r"\\\1", unquote(r["path"])) for r in files.collect()]
    batch_of = files.select(one_slash(F.col("path")).alias("_file"), "batch_id")
    landed = with_event_columns(read_landed_events(spark, paths))
    valid, _ = split_landed_events(landed)
    dealt = valid.join(batch_of, one_slash(F.col("source_file")) == F.col("_file"))
    newest = dealt.groupBy("batch_id").agg(F.max(F.unix_micros("event_ts")).alias("newest"))
    times = list((dict.fromkeys(batches) | {r["batch_id"]: r["newest"] for r in newest.collect()}).items())
    micros = spark.sql(f"SELECT INTERVAL {delay}").first()[0] // timedelta(microseconds=1)
    all_before = unhurried(spark, checkpoint)
    limits = [(b, limit) for b, limit in late_limits(known + times, earlier, micros, all_before) if b > covered]
    count = 0
    if limits:
        by_batch = spark.createDataFrame(limits, "batch_id long, limit long")
        late = (
            dealt.join(F.broadcast(by_batch), "batch_id")
            .filter(F.unix_micros("event_ts") <= F.col("limit"))
            .withColumn(BATCH, F.col("batch_id"))
            .select(*LATE_EVENT.fieldNames())
        )
        write_partitions(late, path, [BATCH])
        written = spark.read.schema(LATE_EVENT).parquet(path)
        count = written.filter(F.col(BATCH).isin([b for b, _ in limits])).count()
    spark.createDataFrame(times, LEDGER).coalesce(1).write.mode("append").parquet(ledger)
    return count

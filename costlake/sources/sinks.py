"""Table writers: partition overwrite, quarantine, keyed upsert, verification."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.functions.values import hash_bucket
from costlake.operators.dedupe import dedupe_rows
from costlake.operators.lookups import keep_directories
from costlake.sources.schemas import ORG_BUCKETS, ServingSpec
from costlake.sources.storage import exists, has_files, mark, remove


#: Optional column of upserted rows: of two versions of a key in one batch the later one is kept.
WRITTEN_AT = "written_at"
#: Next to a table whose staged copy is complete.
COMPLETE = "__staged"


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    sort_by: list[Column] | None = None,
    gather: bool = True,
) -> None:
    """Replace exactly the partitions present in ``df``; a rerun gives the same table.

    Partitions of an earlier run that ``df`` no longer contains stay. The rebalance hint gathers a
    directory's rows into few files, and AQE splits a directory that is too big for one task.
    Rows that come unshuffled from a table of the same layout need no gathering.
    """
    laid_out = df.hint("rebalance", *[F.col(name) for name in partition_by]) if gather else df
    if sort_by:
        laid_out = laid_out.sortWithinPartitions(*partition_by, *sort_by)
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_quarantine(df: DataFrame, path: str) -> None:
    """Replace the rejected set, also by an empty one, so no stale rejects survive a clean rerun."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it back: a short plan, and a size that Spark knows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def verify_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows per written table, to compare between reruns; NULL where nothing was written."""
    counts = [
        (name, spark.read.parquet(path).count() if has_files(spark, path) else None)
        for name, path in paths.items()
    ]
    return spark.createDataFrame(counts, "table_name STRING, total_rows BIGINT")


def clustering_order(spec: ServingSpec) -> list[Column]:
    return [
        F.col(name).desc() if direction == "desc" else F.col(name).asc()
        for name, direction in spec.clustering
    ]


def stored_schema(spec: ServingSpec) -> T.StructType:
    return T.StructType(spec.schema.fields + [T.StructField("org_bucket", T.IntegerType())])


def read_serving(spark: SparkSession, spec: ServingSpec, path: str) -> DataFrame:
    return spark.read.schema(stored_schema(spec)).parquet(path)


def last_write(rows: DataFrame, spec: ServingSpec) -> DataFrame:
    """One row per primary key: the latest by ``written_at`` if the rows have it, then the largest.

    Every column takes part in the order, maps by their sorted entries, so a batch that is computed
    again after a lost executor keeps the same rows.
    """
    order = [F.col(WRITTEN_AT).desc_nulls_last()] if WRITTEN_AT in rows.columns else []
    for field in spec.schema:
        if field.name not in spec.primary_key:
            is_map = isinstance(field.dataType, T.MapType)
            order.append((F.sort_array(F.map_entries(field.name)) if is_map else F.col(field.name)).desc())
    return dedupe_rows(rows, spec.primary_key, order)


def upsert(rows: DataFrame, spec: ServingSpec, path: str) -> None:
    """Insert or replace rows by primary key in a serving table. One writer per table at a time.

    Only the directories that the batch touches are read and rewritten. The merged directories are
    first written in full to a staging folder, then published by dynamic overwrite. If a job dies
    while publishing, the next upsert first publishes the staged copy again, so old rows cannot be
    lost between deletion and replacement. That a staged copy is complete is said by a mark of our own
    that follows the write; committers need not leave one. The first batch of a table replaces nothing
    and needs no staging. Repeating a batch changes nothing.
    """
    spark = rows.sparkSession
    staging = f"{path}__staging"
    finish_staged(spark, spec, path)
    order = [WRITTEN_AT] if WRITTEN_AT in rows.columns else []
    latest = last_write(rows.select(*spec.columns, *order), spec).drop(*order)
    incoming = latest.withColumn("org_bucket", hash_bucket("org_id", ORG_BUCKETS))
    if not has_files(spark, path):
        publish(incoming, spec, path)
        return
    incoming = incoming.persist(StorageLevel.DISK_ONLY)  # read three times
    try:
        _merged(incoming, spec, path).write.mode("overwrite").parquet(staging)
        mark(spark, f"{path}{COMPLETE}")
    finally:
        incoming.unpersist()
    finish_staged(spark, spec, path)


def finish_staged(spark: SparkSession, spec: ServingSpec, path: str) -> None:
    """Publish a completely staged merge. Its mark goes first: a half-deleted staging folder must not
    be taken for a complete one. Without the mark the stored table is still the one before the batch."""
    staging = f"{path}__staging"
    if exists(spark, f"{path}{COMPLETE}"):
        publish(spark.read.schema(stored_schema(spec)).parquet(staging), spec, path)
        remove(spark, f"{path}{COMPLETE}")
    remove(spark, staging)


def publish(rows: DataFrame, spec: ServingSpec, path: str) -> None:
    write_partitions(
        rows, path, list(spec.directories), [F.col("org_id"), *clustering_order(spec)]
    )


def _merged(incoming: DataFrame, spec: ServingSpec, path: str) -> DataFrame:
    """The directories that ``incoming`` touches, with its rows in place of those of equal key."""
    stored = read_serving(incoming.sparkSession, spec, path)
    current = keep_directories(stored, incoming, list(spec.directories))
    same_key = [current[name].eqNullSafe(incoming[name]) for name in spec.primary_key]
    kept = current.join(incoming, same_key, "left_anti").select(*incoming.columns)
    return kept.unionByName(incoming)

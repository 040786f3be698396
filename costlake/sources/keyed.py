"""Partitioned tables whose rows may move: a key that comes again under another partition leaves the old one.

Next to such a table lies an index, key -> partition, in buckets by a hash of the key. A load looks its
keys up there. Partitions that the load brings are replaced whole, as ever. A key that the index puts
into a partition that the load does not bring has moved: that partition is written again without it, together
with the load, or is removed if nothing is left. The index then names the new places.

A load that moves nothing writes the index first and the table after it: an entry for a row that was not
written yet names only a place to look. A load that moves keys is first staged in full (rows, emptied
partitions, index entries) and marked complete; a crash at any later point is mended by publishing the staged
copy again, which the next load, or ``finish_moves``, does. One writer per table at a time.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.functions.values import hash_bucket
from costlake.operators.lookups import keep_directories
from costlake.sources.sinks import COMPLETE, materialise, write_partitions
from costlake.sources.storage import exists, has_files, mark, names, remove, total_bytes

BUCKET = "key_bucket"
#: A bucket of the index for so many bytes of the table, when the index is first made.
TABLE_BYTES_PER_BUCKET = 4 * 1024**3
MOST_BUCKETS = 4096


def index_path(path: str) -> str:
    return f"{path}__keys"


def _buckets(spark: SparkSession, index: str, path: str) -> int:
    """Buckets of an index, as kept in the name of a file in it; a new one goes by the bytes of its table."""
    made = names(spark, index, "width=")
    if made:
        return int(made[0].split("=")[1])
    size = total_bytes(spark, path) if exists(spark, path) else 0
    return min(max(8, -(-size // TABLE_BYTES_PER_BUCKET)), MOST_BUCKETS)


def _entries(rows: DataFrame, keys: list[str], partition_by: str, buckets: int) -> DataFrame:
    key = F.to_json(F.array(*[F.col(name).cast("string") for name in keys]))
    return rows.select(*keys, partition_by).withColumn(BUCKET, hash_bucket(key, buckets))


def _known(index: str, entries: DataFrame) -> DataFrame:
    """What the index says in the buckets that ``entries`` touches; other buckets are not read."""
    if not has_files(entries.sparkSession, f"{index}/entries"):
        return entries.sparkSession.createDataFrame([], entries.schema)
    stored = entries.sparkSession.read.schema(entries.schema).parquet(f"{index}/entries")
    return keep_directories(stored, entries, [BUCKET], MOST_BUCKETS)


def _add_entries(entries: DataFrame, index: str, keys: list[str], buckets: int) -> None:
    """Add or replace the entries of some keys. The touched buckets are first written aside in full, so that
    a crash while they replace the old ones loses none."""
    spark = entries.sparkSession
    _finish_index(spark, index, keys, entries.schema)
    merged = _known(index, entries).join(entries, [*keys, BUCKET], "left_anti").select(*entries.columns)
    merged.unionByName(entries).write.mode("overwrite").parquet(f"{index}/merged")
    mark(spark, f"{index}/width={buckets}")
    mark(spark, f"{index}{COMPLETE}")
    _finish_index(spark, index, keys, entries.schema)


def _finish_index(spark: SparkSession, index: str, keys: list[str], schema: T.StructType) -> None:
    if exists(spark, f"{index}{COMPLETE}"):
        merged = spark.read.schema(schema).parquet(f"{index}/merged")
        write_partitions(merged, f"{index}/entries", [BUCKET], [F.col(name) for name in keys])
        remove(spark, f"{index}{COMPLETE}")


def _places(rows: DataFrame) -> DataFrame:
    """The folders, below the table's, of rows that come from files."""
    return rows.select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("place")).distinct()


def load_keyed(rows: DataFrame, path: str, keys: list[str], partition_by: str) -> int:
    """Write ``rows`` (one per key; no NULL in keys or partition) into the table at ``path``. Partitions in ``rows``
    are replaced, and a key of ``rows`` that lay in another partition leaves it. Returns how many keys did.
    Repeating a load changes nothing."""
    spark = rows.sparkSession
    finish_moves(spark, path, keys, partition_by, rows.schema)
    index, staging = index_path(path), f"{path}__staging"
    buckets = _buckets(spark, index, path)
    rows = rows.persist(StorageLevel.DISK_ONLY)  # read for the index, the moves and the table
    try:
        if has_files(spark, path) and not has_files(spark, f"{index}/entries"):
            # A table from before it had an index.
            table = spark.read.schema(rows.schema).parquet(path)
            _add_entries(_entries(table, keys, partition_by, buckets), index, keys, buckets)
        entries = _entries(rows, keys, partition_by, buckets)
        known = _known(index, entries).withColumnRenamed(partition_by, "_old")
        brought = entries.select(F.col(partition_by).alias("_old")).distinct()
        moved = (
            known.join(entries.drop(partition_by), [*keys, BUCKET])
            .join(brought, "_old", "left_anti")  # a partition that the load brings is replaced anyway
            .select(*keys, F.col("_old").alias(partition_by))
        )
        moved = materialise(moved, f"{staging}/moved")
        count = moved.count()
        if not count:
            _add_entries(entries, index, keys, buckets)
            write_partitions(rows, path, [partition_by])
            remove(spark, staging)
            return 0
        touched = keep_directories(spark.read.schema(rows.schema).parquet(path), moved, [partition_by])
        kept = touched.join(moved, [*keys, partition_by], "left_anti").select(*rows.columns)
        write_partitions(kept.unionByName(rows), f"{staging}/rows", [partition_by])
        staged = spark.read.schema(rows.schema).parquet(f"{staging}/rows")
        _places(touched).join(_places(staged), "place", "left_anti").write.parquet(f"{staging}/emptied")
        entries.write.parquet(f"{staging}/entries")
        mark(spark, f"{staging}/width={buckets}")
        mark(spark, f"{path}{COMPLETE}")
    finally:
        rows.unpersist()
    finish_moves(spark, path, keys, partition_by, rows.schema)
    return count


def finish_moves(
    spark: SparkSession, path: str, keys: list[str], partition_by: str, schema: T.StructType
) -> None:
    """Publish a completely staged load: its rows, then the emptied partitions go, then the index. Each step can be
    repeated. An incomplete staging folder is dropped; the table is then still the one before that load."""
    staging = f"{path}__staging"
    if exists(spark, f"{path}{COMPLETE}"):
        # Staged files lie by partition already and need no gathering.
        staged = spark.read.schema(schema).parquet(f"{staging}/rows")
        write_partitions(staged, path, [partition_by], gather=False)
        for row in spark.read.schema("place string").parquet(f"{staging}/emptied").collect():
            remove(spark, f"{path}/{unquote(row['place'])}")
        buckets = _buckets(spark, staging, path)
        places = _entries(staged, keys, partition_by, buckets)
        _add_entries(spark.read.schema(places.schema).parquet(f"{staging}/entries"), index_path(path), keys, buckets)
        remove(spark, f"{path}{COMPLETE}")
    remove(spark, staging)

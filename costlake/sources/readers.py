"""Batch and streaming file scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.sources.schemas import LANDED_EVENT, TableSpec
from costlake.sources.storage import exists

CORRUPT = "_corrupt_record"


def read_landing(spark: SparkSession, spec: TableSpec, landing_root: str) -> DataFrame:
    """Typed CSV scan with a header row; a malformed cell is read as NULL. Adds ``source_file``."""
    path = f"{landing_root}/{spec.file}"
    if not exists(spark, path):
        raise FileNotFoundError(f"no landing file for table {spec.name}: {path}")
    rows = spark.read.option("header", True).schema(spec.schema).csv(path)
    return rows.withColumn("source_file", F.col("_metadata.file_path"))


def stream_landed_events(
    spark: SparkSession, path: str, max_files: int | None = 50, glob: str = "*.jsonl"
) -> DataFrame:
    """JSON-lines stream. An unreadable line is kept as text in ``_corrupt_record``."""
    reader = (
        spark.readStream.schema(LANDED_EVENT)
        .option("pathGlobFilter", glob)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).withColumn("source_file", F.col("_metadata.file_path"))


def read_landed_events(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The same lines as a static frame, from files given by name."""
    reader = spark.read.schema(LANDED_EVENT).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(paths).withColumn("source_file", F.col("_metadata.file_path"))


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Parquet stream with a declared schema and, if given, a bound on files per micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_declared(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet scan under a declared schema, which also retypes directory columns
    (a ``month=2025-06-01`` directory reads as text when the schema says so)."""
    return spark.read.schema(schema).parquet(path)


def dry_run_count(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Check that a table reads under its declared schema; returns its row count."""
    return read_declared(spark, path, schema).count()

"""Joins with a small side whose size is checked: lookups by key, and directory selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.functions.values import hash_bucket

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
FIELD_OVERHEAD_BYTES = 16
DIRECTORY_LIMIT = 10_000


def measured_bytes(df: DataFrame) -> int | None:
    """Size of a frame, measured by one aggregate over it: 16 bytes a field plus the text bytes.

    None when a column's size is not measured (arrays, maps, structs, binary).
    """
    text_columns = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    sized = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if not all(isinstance(f.dataType, sized) for f in df.schema):
        return None
    text = sum(
        (F.coalesce(F.octet_length(name), F.lit(0)) for name in text_columns), F.lit(0)
    ).cast("long")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(text), F.lit(0)).alias("text")).first()
    return row["n"] * FIELD_OVERHEAD_BYTES * len(df.columns) + row["text"]


def keep_directories(
    table: DataFrame, wanted: DataFrame, columns: list[str], limit: int = DIRECTORY_LIMIT
) -> DataFrame:
    """Rows of a partitioned table whose directory values occur in ``wanted``.

    There are few directories (days, or months by buckets), so their values are listed first and
    become literals: the scan is planned without the other directories. Beyond ``limit`` of them it is
    a plain semi join.
    """
    listed = wanted.select(*columns).distinct()
    found = listed.limit(limit + 1).collect()
    if len(found) > limit:
        return table.join(listed, columns, "left_semi")
    for name in columns:
        table = table.filter(F.col(name).isin({row[name] for row in found if row[name] is not None}))
    if len(columns) == 1:
        return table
    few = table.sparkSession.createDataFrame(found, listed.schema)
    return table.join(F.broadcast(few), columns, "left_semi")


def left_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: str,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    slices: int = 32,
) -> DataFrame:
    """Left join on ``key``; ``lookup`` holds one row per key, so no fact is lost or doubled.

    A lookup measured as small is broadcast, and the facts are not shuffled at all. A bigger one is
    joined by shuffle on (key, slice): facts are sliced by ``spread_by`` and the lookup repeated per
    slice, so a key that holds a large share of the facts is spread over ``slices`` tasks. This also
    serves streams, where Spark does not split skewed partitions by itself. Spark takes the size of a
    compressed file for that of the repeated rows and would broadcast them all; the hint rules that out.
    """
    size = measured_bytes(lookup)
    if size is not None and size <= limit_bytes:
        return facts.join(F.broadcast(lookup), key, "left")
    sliced_facts = facts.withColumn("_slice", hash_bucket(spread_by, slices))
    sliced_lookup = lookup.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return sliced_facts.join(sliced_lookup.hint("merge"), [key, "_slice"], "left").drop("_slice")

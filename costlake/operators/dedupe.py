"""Dedupe on a natural key, for tables and for streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.functions.values import hash_bucket


def dedupe_rows(df: DataFrame, keys: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """One row per key. With ``order_by`` the first row in that order survives, else any row.

    Both forms shrink each input partition to one row per key before the shuffle (partial
    aggregate, or partial window group limit), so a key with very many copies sends at most one
    row per task.
    """
    if not order_by:
        return df.dropDuplicates(keys)
    newest_first = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("_position", F.row_number().over(newest_first))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def total_order(df: DataFrame, names: list[str]) -> list[Column]:
    """Ascending by each of the names that ``df`` has, so that a rerun keeps the same survivor."""
    return [F.col(name).asc_nulls_last() for name in names if name in df.columns]


def dedupe_stream(
    events: DataFrame,
    keys: list[str],
    delay: str = "2 days",
    event_time: str = "event_ts",
    spread_by: str | None = None,
    slices: int = 32,
    keep_forever: bool = False,
) -> DataFrame:
    """One row per key among rows whose event times are closer than the watermark delay.

    State is dropped once the watermark passes it. ``keep_forever`` holds every key for good
    (``dropDuplicates`` on a key without the event time), which never stops growing.

    ``spread_by`` names a column that differs between copies (the source file). Copies are then
    removed per slice first, so that a key with very many copies is spread over ``slices`` tasks
    and at most that many rows of it meet in the second step.
    """
    marked = events.withWatermark(event_time, delay)
    if keep_forever:
        return marked.dropDuplicates(keys)
    if spread_by is None:
        return marked.dropDuplicatesWithinWatermark(keys)
    return (
        marked.withColumn("_slice", hash_bucket(spread_by, slices))
        .dropDuplicatesWithinWatermark([*keys, "_slice"])
        .dropDuplicatesWithinWatermark(keys)
        .drop("_slice")
    )

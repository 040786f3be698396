"""Scalar column expressions shared by batch jobs and streams. All stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_EDGE = float(2**63)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_double(text: Column | str) -> Column:
    """Text to double; anything that is no number becomes NULL instead of failing the job."""
    return as_column(text).try_cast("double")


def parse_timestamp(text: Column | str) -> Column:
    """Text to timestamp, leniently; an unreadable value becomes NULL."""
    return F.try_to_timestamp(as_column(text))


def truncate_to_long(number: Column | str) -> Column:
    """Double to long, dropping the fraction. NaN gives 0 and out-of-range values stop at the edge,
    so that one odd event value cannot fail an ANSI cast."""
    number = as_column(number)
    clamped = F.least(F.greatest(number, F.lit(-LONG_EDGE)), F.lit(LONG_EDGE))
    return F.when(F.isnan(number), F.lit(0.0)).when(number.isNotNull(), clamped).cast("long")


def or_zero(number: Column | str) -> Column:
    return F.coalesce(as_column(number), F.lit(0.0))


def round6(number: Column | str) -> Column:
    return F.round(as_column(number), 6)


def month_bucket(day: Column | str) -> Column:
    return F.date_format(as_column(day), "yyyy-MM")


def hash_bucket(key: Column | str, buckets: int) -> Column:
    """Stable bucket number of a key. On a literal key it folds to a constant and prunes partitions."""
    return F.pmod(F.xxhash64(as_column(key)), F.lit(buckets)).cast("int")

"""Row filters that lose nothing: every input row is in exactly one of the two outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.functions.rules import holds


def split(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). A row on which the rule is NULL is rejected, not lost."""
    rule = holds(rule)
    return df.filter(rule), df.filter(~rule)


def require_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def first_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """A bounded, repeatable sample: top-n per partition, then merged (no full sort)."""
    return df.orderBy(*[F.col(name).asc_nulls_first() for name in order_by]).limit(n)

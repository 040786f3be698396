"""Data quality rules as boolean columns. Every rule here is NULL-safe: it is true or false."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.functions.values import or_zero

# Fixed values of the data contract.
TICKET_SEVERITIES = ["low", "medium", "high", "critical"]
CSAT_RANGE = (1.0, 5.0)
COST_FLOOR_USD = -0.01
Z_SCORE_LIMIT = 3.0
VIOLATION_OF_FLAG = {
    "dq_event_id_not_null": "event_id_null",
    "dq_event_id_unique": "event_id_duplicate",
    "dq_cost_min_threshold": "cost_below_-0.01",
    "dq_unit_when_value": "unit_missing_when_value_present",
}


def holds(condition: Column) -> Column:
    """Two-valued form of a condition: an unknown result counts as a failure."""
    return F.coalesce(condition, F.lit(False))


def all_present(columns: list[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in columns])


def billing_rule() -> Column:
    return holds(all_present(["org_id", "month"]) & (F.col("revenue_usd") > 0.0))


def ticket_rule() -> Column:
    csat = F.col("csat")
    csat_ok = csat.isNull() | csat.between(*CSAT_RANGE)
    return holds(F.col("ticket_id").isNotNull() & F.col("severity").isin(TICKET_SEVERITIES) & csat_ok)


def landed_event_rule() -> Column:
    """A landed line is usable: readable JSON, with id and time, and a numeric value if any."""
    return holds(
        F.col("_corrupt_record").isNull()
        & all_present(["event_id", "event_ts"])
        & ~F.col("is_value_cast_error")
    )


def with_event_flags(events: DataFrame) -> DataFrame:
    """Flag columns and the list of violated rules.

    Uniqueness is guaranteed by the dedupe that follows, so its flag is constant. A low cost is a
    violation but no hard failure: such an event stays in silver with ``anomaly_cost_flag``.
    """
    flags = {
        "dq_event_id_not_null": F.col("event_id").isNotNull(),
        "dq_event_id_unique": F.lit(True),
        "dq_cost_min_threshold": or_zero("cost_usd_increment") >= COST_FLOOR_USD,
        "dq_unit_when_value": F.col("value_num").isNull()
        | (F.coalesce(F.length("unit"), F.lit(0)) > 0),
    }
    return (
        events.withColumns(flags)
        .withColumn("anomaly_cost_flag", ~F.col("dq_cost_min_threshold"))
        .withColumn("dq_violations", violation_list())
    )


def violation_list() -> Column:
    """Names of the failed rules. Built by array concatenation, which has generated code, where a
    lambda filter would drop the whole projection out of it."""
    none = F.array().cast("array<string>")
    parts = [
        F.when(F.col(flag), none).otherwise(F.array(F.lit(name)))
        for flag, name in VIOLATION_OF_FLAG.items()
    ]
    return F.concat(*parts)


def silver_event_rule() -> Column:
    """Hard rules only; what fails them is quarantined."""
    return F.col("dq_event_id_not_null") & F.col("dq_event_id_unique") & F.col("dq_unit_when_value")

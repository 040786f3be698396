"""Usage events: conformance, quality, enrichment, daily features, cost z-scores.

Every function takes and returns a frame and is used by batch jobs and streams alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.functions.rules import Z_SCORE_LIMIT, silver_event_rule, with_event_flags
from costlake.functions.values import or_zero, parse_double, round6, truncate_to_long
from costlake.operators.dedupe import dedupe_rows, total_order
from costlake.operators.lookups import left_lookup
from costlake.operators.splits import split
from costlake.sources.schemas import BRONZE_EVENT, ORG_DIMENSION_COLUMNS


def conform_events(bronze: DataFrame) -> DataFrame:
    """Typed and trimmed events; absent tokens and carbon (schema version 1) count as 0."""
    return bronze.withColumns(
        {
            "event_ts": F.col("event_ts").cast("timestamp"),
            "event_date": F.to_date(F.col("event_ts").cast("timestamp")),
            "value_num": parse_double("value"),
            "cost_usd_increment": F.col("cost_usd_increment").cast("double"),
            "genai_tokens": F.coalesce(F.col("genai_tokens").cast("long"), F.lit(0)),
            "carbon_kg": or_zero(F.col("carbon_kg").cast("double")),
            "metric": F.lower(F.trim("metric")),
            "unit": F.trim("unit"),
        }
    )


def split_events(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver, quarantined) events with quality flags. Neither is deduped yet."""
    return split(with_event_flags(conform_events(bronze)), silver_event_rule())


def silver_events(bronze: DataFrame) -> DataFrame:
    """Batch form of the silver events: accepted and deduped on the event id. Of versions that differ, which
    one stays depends on the rows alone."""
    accepted, _ = split_events(bronze)
    return dedupe_rows(accepted, ["event_id"], total_order(accepted, BRONZE_EVENT.fieldNames()))


def org_dimension(customers: DataFrame) -> DataFrame:
    """The 7 used columns of each org's latest load, so that reloads do not double any event."""
    if "load_date" not in customers.columns:
        return customers.select(*ORG_DIMENSION_COLUMNS)
    narrow = customers.select(*ORG_DIMENSION_COLUMNS, "load_date")
    return dedupe_rows(narrow, ["org_id"], [F.col("load_date").desc_nulls_last()]).drop("load_date")


def enrich_events(events: DataFrame, orgs: DataFrame, **limits) -> DataFrame:
    """Org attributes on each event; an event of an unknown org stays, with NULLs."""
    return left_lookup(events, orgs, "org_id", spread_by="event_id", **limits)


def _metric_total(metric: str, when_missing: float) -> Column:
    amount = F.coalesce(F.col("value_num"), F.lit(when_missing))
    return F.sum(F.when(F.col("metric") == metric, amount).otherwise(0.0))


def daily_features(events: DataFrame) -> DataFrame:
    """Totals per org, service and UTC day. A request event without a value counts as one request.

    Requests are a whole number. Their sum is rounded at 6 digits before the fraction is dropped:
    a sum of doubles may end just below a whole number, depending on the order of the rows.

    Needs no org attribute, so it runs on the events before enrichment: that join keeps exactly the
    event rows, and leaving it out avoids a partitioning by org alone that the aggregate would
    otherwise inherit (one task per org, however large).
    """
    totals = events.groupBy(F.window("event_ts", "1 day").alias("day"), "org_id", "service").agg(
        F.sum(or_zero("cost_usd_increment")).alias("daily_cost_usd"),
        _metric_total("requests", 1.0).alias("requests"),
        _metric_total("cpu_hours", 0.0).alias("cpu_hours"),
        _metric_total("storage_gb_hours", 0.0).alias("storage_gb_hours"),
        F.sum(F.coalesce(F.col("genai_tokens"), F.lit(0))).alias("genai_tokens_total"),
        F.sum(or_zero("carbon_kg")).alias("carbon_kg_total"),
        F.count(F.lit(1)).alias("events_count"),
        F.sum(F.col("anomaly_cost_flag").cast("long")).alias("anomaly_events_count"),
    )
    return totals.withColumns(
        {"event_date": F.to_date("day.start"), "requests": truncate_to_long(round6("requests"))}
    ).drop("day")


def org_day_costs(bronze: DataFrame) -> DataFrame:
    """Cost per UTC day, org and service over all bronze events, also those silver rejects."""
    return bronze.groupBy(F.to_date("event_ts").alias("event_date"), "org_id", "service").agg(
        F.sum(or_zero("cost_usd_increment")).alias("daily_cost_usd")
    )


def baseline_of(costs: DataFrame) -> DataFrame:
    """Mean and sample deviation, per service, of the daily cost of an org."""
    return costs.groupBy("service").agg(
        F.avg("daily_cost_usd").alias("service_mean_cost"),
        F.stddev_samp("daily_cost_usd").alias("service_stddev_cost"),
    )


def day_moments(costs: DataFrame) -> DataFrame:
    """Moments of the cost of an org, per service and day. Those of a changed day replace the old ones."""
    return costs.groupBy("event_date", "service").agg(
        F.count("daily_cost_usd").alias("orgs"),
        F.avg("daily_cost_usd").alias("mean_cost"),
        (F.var_pop("daily_cost_usd") * F.count("daily_cost_usd")).alias("squares"),
    )


def baseline_of_moments(moments: DataFrame) -> DataFrame:
    """``baseline_of`` from moments per day: days are merged by the distance of their means from the common one,
    which loses no digits to big sums of squares. The rows are days and services, however many orgs there are."""
    of_service = Window.partitionBy("service")
    total = F.sum("orgs").over(of_service)
    mean = F.sum(F.col("orgs") * F.col("mean_cost")).over(of_service) / total
    merged = moments.withColumns({"total": total, "mean": mean}).groupBy("service", "total", "mean").agg(
        F.sum(F.col("squares") + F.col("orgs") * F.pow(F.col("mean_cost") - F.col("mean"), F.lit(2.0))).alias("squares")
    )
    deviation = F.when(F.col("total") > 1, F.sqrt(F.col("squares") / (F.col("total") - 1)))
    return merged.select(
        "service", F.col("mean").alias("service_mean_cost"), deviation.alias("service_stddev_cost")
    )


def service_baseline(bronze: DataFrame) -> DataFrame:
    return baseline_of(org_day_costs(bronze))


def with_z_score(features: DataFrame, baseline: DataFrame, **limits) -> DataFrame:
    """z-score of the daily cost and its flag; 0 where a service has no spread.

    ``baseline`` should be a written table: its size is measured to choose the join.
    """
    mean, deviation = F.col("service_mean_cost"), F.col("service_stddev_cost")
    scored = left_lookup(features, baseline, "service", spread_by="org_id", **limits)
    z_score = F.when(deviation > 0.0, (F.col("daily_cost_usd") - mean) / deviation).otherwise(0.0)
    return (
        scored.withColumn("z_score", z_score)
        .withColumn("anomaly_zscore_flag", F.coalesce(F.abs("z_score") > Z_SCORE_LIMIT, F.lit(False)))
        .drop("service_mean_cost", "service_stddev_cost")
    )

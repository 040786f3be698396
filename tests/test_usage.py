from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from costlake.functions.values import truncate_to_long
from costlake.plans.ingest import split_landed_events, with_event_columns
from costlake.plans.marts import anomaly_mart, genai_mart, usage_mart
from costlake.plans.usage import (
    baseline_of,
    baseline_of_moments,
    conform_events,
    daily_features,
    day_moments,
    enrich_events,
    org_dimension,
    service_baseline,
    split_events,
    with_z_score,
)
from costlake.sources.schemas import BRONZE_EVENT, DAILY_FEATURES, LANDED_EVENT
from costlake.sources.sinks import materialise

DAY = datetime(2025, 7, 1, 10)


def bronze(spark, *events):
    """Bronze rows from dicts; what is not given is NULL or a plain default."""
    defaults = {
        "org_id": "o", "service": "api", "metric": "requests", "value": "1", "unit": "count",
        "cost_usd_increment": 1.0, "event_ts": DAY, "source_file": "f",
    }
    records = []
    for number, event in enumerate(events):
        full = {**defaults, "event_id": f"e{number:03}", **event}
        records.append(tuple(full.get(name) for name in BRONZE_EVENT.fieldNames()))
    return spark.createDataFrame(records, BRONZE_EVENT)


def landed(spark, *events):
    records = [tuple(e.get(n) for n in LANDED_EVENT.fieldNames()) for e in events]
    return with_event_columns(spark.createDataFrame(records, LANDED_EVENT))


@pytest.mark.parametrize("value, error", [("abc", True), ("1.5", False), (None, False), ("1e3", False)])
def test_cast_error(spark, value, error):
    row = landed(spark, {"event_id": "a", "timestamp": "2025-07-01T10:00:00Z", "value": value}).first()
    assert row.is_value_cast_error is error
    assert row.event_date == date(2025, 7, 1)


def test_landed_split_loses_nothing(spark):
    good = {"event_id": "a", "timestamp": "2025-07-01 10:00:00", "value": "1"}
    valid, invalid = split_landed_events(
        landed(
            spark, good, {"_corrupt_record": "{bad json"}, {**good, "event_id": None},
            {**good, "timestamp": "yesterday"}, {**good, "timestamp": None}, {**good, "value": "x"},
        )
    )
    assert valid.count() == 1
    assert invalid.count() == 5


def test_conformance(spark):
    row = conform_events(bronze(spark, {"metric": " CPU_Hours ", "unit": " h "})).first()
    assert (row.metric, row.unit, row.genai_tokens, row.carbon_kg) == ("cpu_hours", "h", 0, 0.0)


@pytest.mark.parametrize("cost, anomaly", [(-0.01, False), (-0.0101, True), (None, False)])
def test_low_cost_is_flagged_and_kept(spark, cost, anomaly):
    accepted, rejected = split_events(bronze(spark, {"cost_usd_increment": cost}))
    row = accepted.first()
    assert row.anomaly_cost_flag is anomaly
    assert row.dq_violations == (["cost_below_-0.01"] if anomaly else [])
    assert rejected.isEmpty()


def test_unit_rule(spark):
    accepted, rejected = split_events(
        bronze(spark, {"value": "1", "unit": " "}, {"value": "1", "unit": None}, {"value": None, "unit": None})
    )
    assert rows(accepted.select("event_id")) == [("e002",)]
    assert rows(rejected.select("event_id")) == [("e000",), ("e001",)]
    assert rejected.first().dq_violations == ["unit_missing_when_value_present"]


def test_null_id_is_quarantined_with_all_its_violations(spark):
    _, rejected = split_events(bronze(spark, {"event_id": None, "unit": None, "cost_usd_increment": -1.0}))
    assert rejected.first().dq_violations == [
        "event_id_null", "cost_below_-0.01", "unit_missing_when_value_present",
    ]


def features(spark, *events):
    return daily_features(split_events(bronze(spark, *events))[0])


def test_requests_without_value_count_one(spark):
    row = features(
        spark, {"metric": " Requests ", "value": None}, {"value": "2.6"}, {"metric": "cpu_hours", "value": "9"}
    ).first()
    assert (row.requests, row.cpu_hours, row.storage_gb_hours, row.events_count) == (3, 9.0, 0.0, 3)


def test_requests_do_not_depend_on_row_order(spark):
    for values in (["0.1", "0.7", "0.2"], ["0.7", "0.1", "0.2"]):  # 0.99.. or 1.0 as doubles
        assert features(spark, *[{"value": v} for v in values]).first().requests == 1


def test_truncate_to_long_edges(spark):
    df = spark.createDataFrame([(float("nan"),), (1e300,), (-1e300,), (-2.9,), (None,)], "x DOUBLE")
    assert [r[0] for r in df.select(truncate_to_long("x")).collect()] == [0, 2**63 - 1, -(2**63), -2, None]


def test_days_are_utc(spark):
    edge = datetime(2025, 7, 1, 23, 59, 59)
    got = features(spark, {"event_ts": edge}, {"event_ts": edge + timedelta(seconds=1)})
    assert rows(got.select("event_date")) == [(date(2025, 7, 1),), (date(2025, 7, 2),)]


def scores(spark, folder, *events):
    history = bronze(spark, *events)
    baseline = materialise(service_baseline(history), f"{folder}/baseline")
    return with_z_score(daily_features(split_events(history)[0]), baseline)


def test_z_score_of_one_day_and_of_no_spread(spark, folder):
    got = scores(
        spark, folder, {"service": "single"}, {"service": "flat", "org_id": "a"},
        {"service": "flat", "org_id": "b"},
    )
    assert {tuple(r) for r in got.select("z_score", "anomaly_zscore_flag").collect()} == {(0.0, False)}


def test_z_score_beyond_three(spark, folder):
    events = [{"org_id": f"o{i}", "cost_usd_increment": 1.0} for i in range(11)]
    got = scores(spark, folder, *events, {"org_id": "big", "cost_usd_increment": 100.0})
    assert rows(got.filter("anomaly_zscore_flag").select("org_id")) == [("big",)]
    assert round(got.filter("org_id = 'big'").first().z_score, 6) == round(11 / 12**0.5, 6)


ORG_SCHEMA = """org_id STRING, org_name STRING, industry STRING, plan_tier STRING,
    lifecycle_stage STRING, hq_region STRING, is_enterprise BOOLEAN, load_date DATE"""


def org(key, tier, loaded):
    return (key, key, "retail", tier, "active", "eu", True, loaded)


def test_reloaded_org_does_not_double_events(spark, folder):
    loads = spark.createDataFrame(
        [org("o", "free", date(2025, 7, 1)), org("o", "pro", date(2025, 7, 2))], ORG_SCHEMA
    )
    dimension = materialise(org_dimension(loads), f"{folder}/orgs")
    events = bronze(spark, {}, {"org_id": "unknown"}, {"org_id": None})
    for limits in ({}, {"limit_bytes": 0}):
        got = enrich_events(events, dimension, **limits)
        assert rows(got.select("event_id", "plan_tier")) == [("e000", "pro"), ("e001", None), ("e002", None)]


def test_features_are_the_same_after_enrichment(spark, folder):
    accepted, _ = split_events(bronze(spark, {}, {"org_id": "x"}, {"value": "3"}))
    orgs = spark.createDataFrame([org("o", "pro", date(2025, 7, 1))], ORG_SCHEMA)
    enriched = enrich_events(accepted, org_dimension(orgs))
    assert rows(daily_features(enriched)) == rows(daily_features(accepted))


def feature(**given):
    base = {
        "org_id": "o", "service": "api", "daily_cost_usd": 1.0, "requests": 1, "cpu_hours": 0.0,
        "storage_gb_hours": 0.0, "genai_tokens_total": 0, "carbon_kg_total": 0.0, "events_count": 4,
        "anomaly_events_count": 0, "event_date": date(2025, 7, 1), "z_score": None,
        "anomaly_zscore_flag": None,
    }
    return tuple({**base, **given}[name] for name in DAILY_FEATURES.fieldNames())


def marts_of(spark, *features):
    return usage_mart(spark.createDataFrame(list(features), DAILY_FEATURES))


def test_usage_mart(spark):
    got = marts_of(spark, feature(anomaly_events_count=1), feature(service="idle", events_count=0))
    assert rows(got.select("service", "quality_score", "z_score", "anomaly_zscore_flag", "month_bucket")) == [
        ("api", 0.75, 0.0, False, "2025-07"),
        ("idle", 1.0, 0.0, False, "2025-07"),
    ]


def test_genai_mart_keeps_tokens_of_other_services(spark):
    got = marts_of(
        spark, feature(genai_tokens_total=5), feature(service="genai", daily_cost_usd=2.0),
        feature(service="db", daily_cost_usd=3.0),
    )
    assert rows(genai_mart(got).select("genai_tokens_total", "estimated_cost_usd")) == [(0, 2.0), (5, 1.0)]


def test_anomaly_mart(spark):
    got = marts_of(
        spark, feature(anomaly_events_count=1), feature(service="z", anomaly_zscore_flag=True),
        feature(service="quiet"),
    )
    assert rows(anomaly_mart(got).select("service")) == [("api",), ("z",)]


def test_rules_stay_in_generated_code(spark):
    accepted, _ = split_events(bronze(spark, {}).filter(F.rand() < 2))
    assert "*(1) Project" in accepted._jdf.queryExecution().executedPlan().toString()


def test_merged_moments_equal_the_baseline_over_all_costs(spark):
    costs = spark.range(4000).selectExpr(
        "date_add(DATE'2025-01-01', CAST(id % 37 AS INT)) AS event_date", "CAST(id % 211 AS STRING) AS org_id",
        "IF(id % 5 = 0, NULL, CONCAT('s', id % 3)) AS service",
        # Far from zero and close together: sums of squares would lose the spread.
        "1e6 + pmod(xxhash64(id), 1000) / 1000 AS daily_cost_usd",
    ).union(spark.sql("SELECT DATE'2025-01-01', 'o', 'once', 7.0D"))
    merged, full = baseline_of_moments(day_moments(costs)), baseline_of(costs)
    pairs = full.join(merged.toDF("name", "mean", "deviation"), F.col("service").eqNullSafe(F.col("name"))).collect()
    assert len(pairs) == full.count() == merged.count() == 5
    for r in pairs:
        assert r["mean"] == pytest.approx(r.service_mean_cost, rel=1e-12)
        if r.service == "once":
            assert r.deviation is None and r.service_stddev_cost is None
        else:
            assert r.deviation == pytest.approx(r.service_stddev_cost, rel=1e-9)

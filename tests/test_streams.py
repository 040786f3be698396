import json
import os
import shutil
import time
from datetime import date, datetime, timedelta
from glob import glob

import pytest

from conftest import SF_DIR, rows
from costlake.checks.views import bronze_events
from costlake.operators.dedupe import dedupe_stream
from costlake.plans import flows
from costlake.plans.usage import daily_features, service_baseline, silver_events, split_events, with_z_score
from costlake.sources.readers import read_declared, stream_landed_events, stream_parquet
from costlake.sources.schemas import (
    BRONZE_EVENT,
    DAILY_FEATURES,
    GOLD_MARTS,
    SERVING_TABLES,
    SILVER_EVENT,
)
from costlake.sources.sinks import materialise, read_serving
from costlake.sources.storage import exists
from costlake.streaming import jobs
from costlake.streaming.counts import dropped_rows
from costlake.streaming.jobs import (
    await_all,
    features_stream,
    gather,
    start_append,
    start_bronze,
    start_features,
    start_quarantine_samples,
    start_serving,
    start_silver,
    trigger,
)
from test_usage import ORG_SCHEMA, bronze

NOON = datetime(2025, 7, 1, 12)


def land(folder, name, *lines):
    with open(f"{folder}/{name}.jsonl", "w", encoding="utf-8") as out:
        for line in lines:
            out.write((line if isinstance(line, str) else json.dumps(line)) + "\n")


def line(key, at="2025-07-01T12:00:00Z", **more):
    return {"event_id": key, "timestamp": at, "value": "1", "unit": "count", "metric": "requests", **more}


def drain_bronze(spark, folder, max_files=50, **options):
    stream = stream_landed_events(spark, f"{folder}/landing", max_files)
    return await_all(start_bronze(stream, f"{folder}/bronze", f"{folder}/ckp", **options))


def bronze_ids(spark, folder):
    table = read_declared(spark, f"{folder}/bronze/streaming/usage_events", BRONZE_EVENT)
    return [r.event_id for r in table.orderBy("event_id").collect()]


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "landing").mkdir()
    return str(tmp_path / "landing")


def test_bronze_splits_dedupes_and_restarts(spark, folder, landing):
    land(landing, "one", line("a"), line("a"), "{bad json", line("b", "never"), line("c", value="x"), line(None))
    land(landing, "two", line("a"), line("d", genai_tokens=7, carbon_kg=0.5, schema_version=2))
    with open(f"{landing}/ignored.txt", "w", encoding="utf-8") as out:
        out.write(json.dumps(line("z")))
    drain_bronze(spark, folder)
    assert bronze_ids(spark, folder) == ["a", "d"]
    invalid = spark.read.schema(BRONZE_EVENT).parquet(f"{folder}/bronze/quarantine/usage_events_invalid")
    assert invalid.count() == 4
    assert [r._corrupt_record for r in invalid.filter("_corrupt_record IS NOT NULL").collect()] == ["{bad json"]

    drain_bronze(spark, folder)
    land(landing, "three", line("a"), line("e"))
    drain_bronze(spark, folder)
    assert bronze_ids(spark, folder) == ["a", "d", "e"]


def test_files_per_batch_are_bounded(spark, folder, landing):
    for number in range(3):
        land(landing, f"f{number}", line(f"e{number}"))
    queries = drain_bronze(spark, folder, max_files=1)
    read = [r.numInputRows for r in queries[0].recentProgress if r.numInputRows]
    assert read == [1, 1, 1]


def test_late_rows_are_dropped_and_counted(spark, folder, landing):
    for name, at in [("1", "2025-07-01"), ("2", "2025-07-20"), ("3", "2025-07-21")]:
        land(landing, name, line(name, f"{at}T12:00:00Z"))
        drain_bronze(spark, folder)
    for number in range(3):
        land(landing, f"late{number}", line(f"late{number}", "2025-07-02T12:00:00Z"))
    land(landing, "recent", line("recent", "2025-07-20T13:00:00Z"), line("recent", "2025-07-20T13:00:00Z"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 1)  # the count needs no more
    try:
        with dropped_rows(spark) as dropped:
            queries = drain_bronze(spark, folder, max_files=1)
            assert dropped.of(queries) == (3, 1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert bronze_ids(spark, folder) == ["1", "2", "3", "recent"]


def test_files_of_a_micro_batch_do_not_grow_with_the_shuffle_width(spark, folder):
    events = [{"event_id": f"e{n}"} for n in range(300)]
    bronze(spark, *events).write.parquet(f"{folder}/source")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for width in (4, 24):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            deduped = dedupe_stream(stream_parquet(spark, f"{folder}/source", BRONZE_EVENT), ["event_id"])
            gathered = gather(deduped, "event_date", "event_id", most=2)
            start_append(gathered, f"{folder}/out{width}", f"{folder}/ckp{width}", "event_date").awaitTermination()
            assert len(glob(f"{folder}/out{width}/event_date=*/*.parquet")) <= 2
            assert read_declared(spark, f"{folder}/out{width}", BRONZE_EVENT).count() == 300
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_id_is_spread_and_kept_once(spark, folder):
    source = f"{folder}/source"
    for name in ("f1", "f2", "f3"):
        hot = [{"event_id": "hot", "source_file": name}] * 50
        bronze(spark, *hot, {"event_id": f"only-{name}", "source_file": name}).write.mode("append").parquet(source)
    stream = stream_parquet(spark, source, BRONZE_EVENT, 1)
    deduped = dedupe_stream(stream, ["event_id"], spread_by="source_file")
    assert "_slice" not in deduped.columns
    start_append(deduped, f"{folder}/out", f"{folder}/ckp").awaitTermination()
    got = read_declared(spark, f"{folder}/out", BRONZE_EVENT)
    assert rows(got.select("event_id")) == [("hot",), ("only-f1",), ("only-f2",), ("only-f3",)]


@pytest.mark.parametrize("keep_forever, expected", [(False, 2), (True, 1)])
def test_state_is_dropped_after_the_delay(spark, folder, keep_forever, expected):
    """A second copy far beyond the delay is a new event, unless every key is kept for good."""
    source = f"{folder}/source"
    for step, (key, at) in enumerate([("a", NOON), ("b", NOON + timedelta(days=9)), ("a", NOON + timedelta(days=10))]):
        bronze(spark, {"event_id": key, "event_ts": at}).write.mode("append").parquet(source)
        deduped = dedupe_stream(
            stream_parquet(spark, source, BRONZE_EVENT), ["event_id"], keep_forever=keep_forever
        )
        start_append(deduped, f"{folder}/out", f"{folder}/ckp").awaitTermination()
    got = read_declared(spark, f"{folder}/out", BRONZE_EVENT)
    assert got.filter("event_id = 'a'").count() == expected


def test_streamed_features_equal_batch_on_closed_days(spark, folder):
    source = f"{folder}/source"
    bronze_events(spark, SF_DIR).write.parquet(source)
    events = read_declared(spark, source, BRONZE_EVENT)
    baseline = materialise(service_baseline(events), f"{folder}/baseline")
    batch = with_z_score(daily_features(silver_events(events)), baseline)
    accepted, _ = split_events(stream_parquet(spark, source, BRONZE_EVENT))
    start_append(
        features_stream(accepted, baseline), f"{folder}/out", f"{folder}/ckp", "event_date"
    ).awaitTermination()
    streamed = read_declared(spark, f"{folder}/out", DAILY_FEATURES)
    last_closed = max(r.event_date for r in streamed.select("event_date").collect())
    end = events.agg({"event_ts": "max"}).first()[0] - timedelta(days=2)
    assert datetime.combine(last_closed, datetime.min.time()) + timedelta(days=1) <= end
    digits = [
        f"ROUND({f.name}, 6) AS {f.name}" if f.dataType.typeName() == "double" else f.name
        for f in DAILY_FEATURES
    ]
    expected = batch.filter(batch.event_date <= last_closed).selectExpr(*digits)
    got = streamed.selectExpr(*digits)
    assert got.count() > 100
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


@pytest.mark.parametrize("cap, expected", [(None, 5), (3, 3)])
def test_quarantine_samples(spark, folder, cap, expected):
    bronze(spark, *[{"unit": None} for _ in range(5)]).write.parquet(f"{folder}/source")
    _, rejected = split_events(stream_parquet(spark, f"{folder}/source", BRONZE_EVENT))
    start_quarantine_samples(rejected, f"{folder}/out", f"{folder}/ckp", cap).awaitTermination()
    sample = spark.read.option("recursiveFileLookup", True).json(f"{folder}/out")
    assert sample.count() == expected
    assert sample.first().dq_violations == ["unit_missing_when_value_present"]


def test_tokens_of_one_key_in_two_micro_batches_add_up(spark, folder):
    name = "genai_tokens_by_org_date"
    schema = GOLD_MARTS[name]
    mart = f"{folder}/mart"
    for tokens, cost in [(5, 1.5), (7, 2.0)]:
        row = ("o", "2025-07", date(2025, 7, 1), tokens, cost)
        spark.createDataFrame([row], schema).write.mode("append").parquet(mart)
    start_serving(
        stream_parquet(spark, mart, schema, 1), name, f"{folder}/serving", f"{folder}/ckp", mart_path=mart
    ).awaitTermination()
    got = read_serving(spark, SERVING_TABLES[name], f"{folder}/serving")
    assert rows(got.select("genai_tokens_total", "estimated_cost_usd")) == [(12, 3.5)]


def test_continuous_trigger(spark, folder, landing, monkeypatch):
    assert trigger() == {"availableNow": True}
    assert trigger(continuous=True) == {"processingTime": "30 seconds"}
    monkeypatch.setattr(jobs, "trigger", lambda continuous: {"processingTime": "1 second"})
    land(landing, "one", line("a"))
    stream = stream_landed_events(spark, landing)
    queries = start_bronze(stream, f"{folder}/bronze", f"{folder}/ckp", continuous=True)
    try:
        for query in queries:
            query.processAllAvailable()
            assert query.isActive
    finally:
        for query in queries:
            query.stop()
    assert bronze_ids(spark, folder) == ["a"]


def test_whole_streaming_flow(spark, folder, landing):
    start = time.strptime("2025-07-01", "%Y-%m-%d")
    day_of = lambda n: f"{start.tm_year}-07-{n:02}T10:00:00Z"
    land(
        landing, "events",
        *[line(f"e{n}", day_of(n), org_id="o", service="genai", cost_usd_increment=2.0, genai_tokens=3)
          for n in range(1, 8)],
        line("bad-unit", day_of(1), unit=None, org_id="o", service="api"),
        line("low", day_of(2), org_id="o", service="api", cost_usd_increment=-5.0),
    )
    lake = flows.Lake(folder)
    orgs = [("o", "Org", "retail", "pro", "active", "eu", True, date(2025, 7, 1))]
    spark.createDataFrame(
        orgs, """org_id STRING, org_name STRING, industry STRING, plan_tier STRING,
        lifecycle_stage STRING, hq_region STRING, is_enterprise BOOLEAN, load_date DATE"""
    ).write.partitionBy("load_date").parquet(f"{lake.bronze}/batch/customers_orgs")
    for _ in range(2):  # the rerun finds nothing new
        counts = dict(rows(flows.run_streaming(spark, landing, lake, sample_cap=10)))
        assert not counts.pop("bronze/usage_events_invalid")
        assert (counts.pop("dropped/late"), counts.pop("dropped/copies")) == (0, 0)
        assert counts == {
            "bronze/usage_events": 9, "silver/events_enriched": 8, "silver/distinct_event_ids": 8,
            "silver/features_org_daily": 5, "silver/events_quality_issues": 1,
            "gold/org_daily_usage_by_service": 5,
        }
        genai = read_serving(spark, SERVING_TABLES["genai_tokens_by_org_date"], lake.serving("genai_tokens_by_org_date"))
        assert genai.count() == 4
        anomalies = read_serving(spark, SERVING_TABLES["cost_anomaly_mart"], lake.serving("cost_anomaly_mart"))
        assert rows(anomalies.select("service", "anomaly_events_count")) == [("api", 1)]
    samples = spark.read.option("recursiveFileLookup", True).json(f"{lake.silver}/quarantine/samples")
    assert [r.event_id for r in samples.collect()] == ["bad-unit"]


def test_several_days_in_one_silver_batch_are_not_late(spark, folder, landing):
    days = [f"2025-07-{n:02}" for n in range(1, 13)]
    for number, day in enumerate(days):
        land(landing, f"{number:02}", *[line(f"{day}-{i}", f"{day}T0{i}:00:00Z", org_id="o") for i in range(5)])
        arrived = time.time() - 100 + number  # files are read in order of arrival
        os.utime(f"{landing}/{number:02}.jsonl", (arrived, arrived))
    lake = flows.Lake(folder)
    drain_bronze(spark, folder, max_files=1)
    assert len(bronze_ids(spark, folder)) == 60
    bronze_stream = stream_parquet(spark, f"{lake.bronze}/streaming/usage_events", BRONZE_EVENT)
    orgs = spark.createDataFrame([], ORG_SCHEMA).drop("load_date")
    await_all(start_silver(bronze_stream, orgs, lake.silver, lake.checkpoints))
    silver = stream_parquet(spark, f"{lake.silver}/events_enriched", SILVER_EVENT)
    start_features(silver, flows.refresh_baseline(spark, lake), lake.silver, lake.checkpoints).awaitTermination()
    features = read_declared(spark, f"{lake.silver}/features_org_daily", DAILY_FEATURES)
    got = rows(features.select("event_date", "events_count"))
    assert got == [(date.fromisoformat(day), 5) for day in days[:9]]


def test_bounded_silver_equals_unbounded(spark, folder, landing):
    days = [f"2025-07-{n:02}" for n in range(1, 9)]
    for day in days:
        land(landing, day, *[line(f"{day}-{i % 6}", f"{day}T0{i}:00:00Z", org_id="o") for i in range(8)])
    drain_bronze(spark, folder, max_files=None)
    path = f"{folder}/bronze/streaming/usage_events"
    orgs = spark.createDataFrame([], ORG_SCHEMA).drop("load_date")
    got = []
    for name, bound, options in [("one", None, {}), ("many", 1, {"dedupe": False})]:
        stream = stream_parquet(spark, path, BRONZE_EVENT, bound)
        queries = await_all(start_silver(stream, orgs, f"{folder}/{name}", f"{folder}/ckp/{name}", **options))
        batches = queries[0].lastProgress["batchId"]
        assert batches > 1 if bound else batches <= 1
        silver = read_declared(spark, f"{folder}/{name}/events_enriched", SILVER_EVENT)
        got.append(rows(silver.select("event_id", "event_ts", "org_id", "event_date")))
    assert len(got[0]) == 48 and got[0] == got[1]


@pytest.mark.parametrize("streamed", [False, True])
def test_baseline_refresh_reads_changed_days_and_equals_the_full_one(spark, folder, streamed):
    lake = flows.Lake(folder)
    path = f"{lake.bronze}/streaming/usage_events"

    def add(*events):
        time.sleep(1.1)  # file times must differ
        columns = [name for name in BRONZE_EVENT.fieldNames() if name != "event_date"]
        frame = bronze(spark, *events).select(*columns, "event_date")
        frame = frame.withColumn("event_date", frame.event_ts.cast("date"))
        if not streamed:
            frame.write.mode("append").partitionBy("event_date").parquet(path)
            return
        frame.write.mode("append").parquet(f"{folder}/source")
        stream = stream_parquet(spark, f"{folder}/source", BRONZE_EVENT)
        start_append(stream, path, f"{folder}/checkpoint", "event_date").awaitTermination()
        # The days come from the sink's log: files that it does not list are not looked at.
        assert exists(spark, f"{path}/_spark_metadata")

    def check():
        both = [
            flows.refresh_baseline(spark, lake), service_baseline(read_declared(spark, path, BRONZE_EVENT))
        ]
        got, full = [
            rows(df.selectExpr("service", "ROUND(service_mean_cost, 9)", "ROUND(service_stddev_cost, 9)"))
            for df in both
        ]
        assert got == full

    assert flows.refresh_baseline(spark, lake).isEmpty()
    add({"org_id": "a"}, {"org_id": "b", "cost_usd_increment": 3.0})
    check()
    add({"event_ts": NOON + timedelta(days=1), "org_id": "a", "cost_usd_increment": 9.0})
    check()
    add({"org_id": "a", "cost_usd_increment": 0.5}, {"service": "db"})
    check()
    other_day = f"{lake.silver}/service_day_moments/event_date=2025-07-02/*.parquet"
    before = glob(other_day)
    add({"org_id": "c", "cost_usd_increment": 8.0})
    check()
    assert before and glob(other_day) == before
    shutil.rmtree(f"{lake.silver}/service_day_moments/event_date=2025-07-02")
    check()

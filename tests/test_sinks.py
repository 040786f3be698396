from datetime import date
from glob import glob

import pytest
from pyspark.sql import functions as F

import costlake.sources.sinks as sinks
from conftest import rows
from costlake.plans import serving
from costlake.sources.schemas import ORG_BUCKETS, SERVING_TABLES
from costlake.sources.sinks import (
    materialise,
    read_serving,
    upsert,
    write_partitions,
    write_quarantine,
)
from costlake.sources.storage import read_or_empty

USAGE = SERVING_TABLES["org_daily_usage_by_service"]


def usage(spark, *records):
    """(org, day, service, cost) as full serving rows."""
    full = []
    for org, day, service, cost in records:
        values = {
            "org_id": org, "month_bucket": day[:7], "event_date": date.fromisoformat(day),
            "service": service, "daily_cost_usd": cost, "requests": 1,
        }
        full.append(tuple(values.get(name) for name in USAGE.columns))
    return spark.createDataFrame(full, USAGE.schema)


def stored(spark, path):
    table = read_serving(spark, USAGE, path)
    return [
        (r.org_id, str(r.event_date), r.service, r.daily_cost_usd)
        for r in table.orderBy("org_id", "event_date", "service").collect()
    ]


def test_overwrite_replaces_only_present_partitions(spark, folder):
    path = f"{folder}/t"
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p STRING, v INT")
    write_partitions(df, path, ["p"])
    write_partitions(df.filter("p = 'b'").selectExpr("p", "v + 10 AS v"), path, ["p"])
    assert rows(spark.read.parquet(path).select("p", "v")) == [("a", 1), ("b", 12)]


def test_partition_is_one_sorted_file(spark, folder):
    df = spark.range(1000).selectExpr("1 AS p", "999 - id AS v").repartition(4)
    write_partitions(df, f"{folder}/t", ["p"], [df.v.asc()])
    assert len(glob(f"{folder}/t/p=1/*.parquet")) == 1
    assert [r.v for r in spark.read.parquet(f"{folder}/t").collect()] == list(range(1000))


def test_ungathered_write_has_no_shuffle_and_the_same_rows(spark, folder):
    df = spark.range(10).selectExpr("id % 2 AS p", "id AS v")
    write_partitions(df, f"{folder}/t", ["p"], gather=False)
    assert rows(spark.read.parquet(f"{folder}/t").select("v")) == [(i,) for i in range(10)]


def test_upsert_prunes_untouched_directories(spark, folder):
    path = f"{folder}/serving"
    upsert(usage(spark, ("a", "2025-06-01", "api", 1.0), ("a", "2025-07-01", "api", 2.0)), USAGE, path)
    incoming = usage(spark, ("a", "2025-07-01", "api", 3.0)).withColumn(
        "org_bucket", sinks.hash_bucket("org_id", ORG_BUCKETS)
    )
    plan = sinks._merged(incoming, USAGE, path)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan parquet") :]
    assert "month_bucket" in scan[scan.index("PartitionFilters") :] and "2025-07" in scan


def test_clean_rerun_empties_the_quarantine(spark, folder):
    df = spark.range(3)
    write_quarantine(df, f"{folder}/q")
    write_quarantine(df.limit(0), f"{folder}/q")
    assert spark.read.schema("id BIGINT").parquet(f"{folder}/q").count() == 0


def test_missing_table_reads_as_empty(spark, folder):
    assert read_or_empty(spark, f"{folder}/none", USAGE.schema).count() == 0
    materialise(spark.range(2), f"{folder}/two")
    assert read_or_empty(spark, f"{folder}/two", spark.range(1).schema).count() == 2


def test_upsert_replaces_by_key_and_keeps_the_rest(spark, folder):
    path = f"{folder}/serving"
    upsert(usage(spark, ("a", "2025-06-01", "api", 1.0), ("a", "2025-07-01", "api", 2.0),
                 ("b", "2025-07-01", None, 3.0)), USAGE, path)
    before = set(glob(f"{path}/month_bucket=2025-06/*/*.parquet"))
    upsert(usage(spark, ("a", "2025-07-01", "api", 20.0), ("b", "2025-07-01", None, 30.0),
                 ("b", "2025-07-01", "db", 4.0)), USAGE, path)
    assert stored(spark, path) == [
        ("a", "2025-06-01", "api", 1.0), ("a", "2025-07-01", "api", 20.0),
        ("b", "2025-07-01", None, 30.0), ("b", "2025-07-01", "db", 4.0),
    ]
    assert before == set(glob(f"{path}/month_bucket=2025-06/*/*.parquet"))


def test_upsert_of_nothing(spark, folder):
    upsert(usage(spark, ("a", "2025-06-01", "api", 1.0)), USAGE, f"{folder}/s")
    upsert(usage(spark), USAGE, f"{folder}/s")
    upsert(usage(spark), USAGE, f"{folder}/new")
    assert stored(spark, f"{folder}/s") == [("a", "2025-06-01", "api", 1.0)]


def test_one_row_per_key_within_a_batch(spark, folder):
    upsert(usage(spark, ("a", "2025-06-01", "api", 1.0), ("a", "2025-06-01", "api", 5.0)), USAGE, f"{folder}/s")
    assert stored(spark, f"{folder}/s") == [("a", "2025-06-01", "api", 5.0)]


def test_upsert_survives_a_crash_while_publishing(spark, folder, monkeypatch):
    path = f"{folder}/serving"
    upsert(usage(spark, ("a", "2025-06-01", "api", 1.0)), USAGE, path)
    second = usage(spark, ("a", "2025-06-01", "db", 2.0))

    def lose_partition_and_die(staged, target, *layout):
        import shutil

        shutil.rmtree(f"{target}/month_bucket=2025-06")
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "write_partitions", lose_partition_and_die)
        with pytest.raises(RuntimeError):
            upsert(second, USAGE, path)
    upsert(usage(spark, ("b", "2025-06-01", "api", 3.0)), USAGE, path)
    assert stored(spark, path) == [("a", "2025-06-01", "api", 1.0), ("a", "2025-06-01", "db", 2.0),
                                   ("b", "2025-06-01", "api", 3.0)]
    assert not glob(f"{path}__staging")


def test_upsert_needs_no_success_mark_of_the_committer(spark, folder):
    path, setting = f"{folder}/serving", "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set(setting, "false")
    try:
        upsert(usage(spark, ("a", "2025-06-01", "api", 1.0)), USAGE, path)
        upsert(usage(spark, ("a", "2025-06-01", "api", 5.0)), USAGE, path)
    finally:
        hadoop.unset(setting)
    assert stored(spark, path) == [("a", "2025-06-01", "api", 5.0)]
    assert not glob(f"{path}__*")


def test_last_write_keeps_the_later_version(spark):
    rows = usage(spark, ("a", "2025-06-01", "api", 9.0)).withColumn("written_at", F.lit(1)).unionByName(
        usage(spark, ("a", "2025-06-01", "api", 2.0)).withColumn("written_at", F.lit(2))
    )
    assert [r.daily_cost_usd for r in sinks.last_write(rows, USAGE).collect()] == [2.0]


def test_stored_query_reads_one_bucket(spark, folder):
    path = f"{folder}/serving"
    many = [(f"org{i}", "2025-07-02", "api", float(i)) for i in range(4 * ORG_BUCKETS)]
    upsert(usage(spark, *many), USAGE, path)
    table = read_serving(spark, USAGE, path)
    got = serving.daily_costs(table, "org5", "2025-07", "2025-07-01", "2025-07-31")
    assert [r.daily_cost_usd for r in got.collect()] == [5.0]
    text = got._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters") :]
    assert "org_bucket" in filters and "month_bucket" in filters
    assert "EqualTo(org_id,org5)" in filters

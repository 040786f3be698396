"""Late rows as rows: they are those that Spark reports as dropped, at any bound, once each."""

import json
import time

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from costlake.checks.queries import landed_backwards
from costlake.checks.views import landed_lines
from costlake.sources.readers import stream_landed_events
from costlake.sources.schemas import BRONZE_EVENT
from costlake.streaming import late
from costlake.streaming.counts import dropped_rows
from costlake.streaming.jobs import await_all, start_bronze
from costlake.streaming.late import LATE_EVENT, keep_late, late_limits


def land(folder, name, *events):
    with open(f"{folder}/{name}.jsonl", "w") as out:
        for event_id, at in events:
            line = {"event_id": event_id, "timestamp": at, "org_id": "o", "service": "s", "metric": "m", "value": "1"}
            out.write(json.dumps(line) + "\n")
    time.sleep(0.02)  # files are taken in the order of their times


def drain(spark, folder, max_files):
    lines = stream_landed_events(spark, f"{folder}/in", max_files)
    with dropped_rows(spark) as dropped:
        return dropped.of(await_all(start_bronze(lines, f"{folder}/bronze", f"{folder}/cp")))


def kept_late(spark, folder, **options):
    return keep_late(spark, f"{folder}/cp/bronze/usage_events", f"{folder}/late", "2 days", **options)


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "in").mkdir()
    return str(tmp_path)


def test_limits_follow_the_micro_batches_before_the_last_one():
    ms = 1000
    newest = [(0, 5 * ms + 7), (1, 9 * ms + 999), (2, None), (4, 20 * ms), (5, 1)]
    # The limit of 4 counts 0 to 2, as 3 had no rows of its own; that of 5 counts 0 to 3.
    assert late_limits(newest, None, 2 * ms) == [(2, 3 * ms), (4, 7 * ms), (5, 7 * ms)]
    assert late_limits([(6, 30 * ms), (7, 0), (8, 0)], 4 * ms, 0) == [(6, 4 * ms), (7, 4 * ms), (8, 30 * ms)]
    assert late_limits([(0, 1)], None, 1) == []
    # A start tests its first micro-batch against all that were committed.
    assert late_limits([(0, 5 * ms), (1, 9 * ms), (2, 0)], None, 2 * ms, {0, 1}) == [(1, 3 * ms), (2, 3 * ms)]


@pytest.mark.parametrize("max_files", [1, 2, None])
def test_kept_rejected_late_and_copies_are_all_there_is(spark, landing, max_files):
    files = {
        "a 1": [("a1", "2024-01-10 00:00:00")],
        "b": [("b1", "2024-01-01 00:00:00"), ("b2", "2024-01-20 00:00:00.123456"), ("a1", "2024-01-10 00:00:00")],
        "c": [("c1", "2024-01-07 00:00:00"), ("c2", "2024-01-08 00:00:00"), ("c3", "2024-01-08 00:00:00.000001"), ("bad", "no time")],
        "d": [("d1", "2024-01-09 00:00:00"), ("d2", "2024-01-18 00:00:00.123"), ("d3", "2024-01-18 00:00:00.124")],
        "e": [("e1", "2024-01-02 00:00:00")],
    }
    for name, events in files.items():
        land(f"{landing}/in", name, *events)
    reported, copies = drain(spark, landing, max_files)
    assert kept_late(spark, landing) == reported
    assert kept_late(spark, landing) == 0
    # A second run goes on from the checkpoint and the ledger.
    more = {"f": [("f1", "2024-01-17 00:00:00"), ("f2", "2024-01-18 00:00:00.5")], "g": [("g1", "2024-01-17 00:00:00")]}
    for name, events in more.items():
        land(f"{landing}/in", name, *events)
    reported_later, copies_later = drain(spark, landing, max_files)
    assert kept_late(spark, landing) == reported_later >= 1
    kept = rows(spark.read.schema(BRONZE_EVENT).parquet(f"{landing}/bronze/streaming/usage_events").select("event_id"))
    rejected = spark.read.parquet(f"{landing}/bronze/quarantine/usage_events_invalid").count()
    dropped = rows(spark.read.schema(LATE_EVENT).parquet(f"{landing}/late").select("event_id"))
    total = sum(map(len, [*files.values(), *more.values()]))
    assert len(kept) + len(dropped) + rejected + copies + copies_later == total
    valid = {e for events in [*files.values(), *more.values()] for e, _ in events} - {"bad"}
    assert {r[0] for r in kept} | {r[0] for r in dropped} == valid
    if max_files == 1:
        assert [r[0] for r in dropped] == ["c1", "c2", "d1", "d2", "e1", "f1", "g1"]


def test_few_micro_batches_at_a_time_give_the_same_rows(spark, landing):
    for i, day in enumerate([20, 3, 21, 4, 5, 22, 6]):
        land(f"{landing}/in", f"f{i}", (f"e{i}", f"2024-01-{day:02} 00:00:00"))
    reported, _ = drain(spark, landing, 1)
    assert kept_late(spark, landing, most_batches=1) == reported > 0


def test_a_run_that_dies_before_its_ledger_is_repeated_without_doubles(spark, landing, monkeypatch):
    for i, day in enumerate([20, 3, 21, 4, 5]):
        land(f"{landing}/in", f"f{i}", (f"e{i}", f"2024-01-{day:02} 00:00:00"))
    reported, _ = drain(spark, landing, 1)
    write = late.write_partitions

    def die(*args):
        write(*args)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(late, "write_partitions", die)
    with pytest.raises(RuntimeError):
        kept_late(spark, landing)
    monkeypatch.undo()
    assert kept_late(spark, landing) == reported
    assert spark.read.parquet(f"{landing}/late").count() == reported


def test_nothing_landed_yet(spark, landing):
    assert kept_late(spark, landing) == 0


def test_landing_parts_are_files_of_bounded_size(spark, tmp_path):
    """Newest part first, each line in two files, and no file holds a whole part."""
    path, files = landed_backwards(spark, SF_DIR, str(tmp_path), file_lines=50)
    assert files == 5
    lines = spark.read.text(path).withColumn("file", F.input_file_name())
    assert lines.count() == 2 * landed_lines(spark, SF_DIR).count()
    assert lines.select("value").exceptAll(landed_lines(spark, SF_DIR)).exceptAll(landed_lines(spark, SF_DIR)).isEmpty()
    assert max(r["count"] for r in lines.groupBy("file").count().collect()) <= 100
    parts = lines.withColumn("part", F.regexp_extract("file", "landing/([ab][0-3])/", 1))
    at = F.try_to_timestamp(F.get_json_object("value", "$.timestamp"))
    timed = parts.filter(at > "2024-01-02").groupBy("part").agg(F.min(at).alias("low"), F.max(at).alias("high"))
    spans = {r["part"]: (r["low"], r["high"]) for r in timed.collect()}
    assert set(spans) == {c + str(i) for c in "ab" for i in range(4)}
    assert all(spans[f"{c}{i}"][0] >= spans[f"{c}{i + 1}"][1] for c in "ab" for i in range(3))

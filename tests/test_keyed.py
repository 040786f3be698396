"""Keys that move between partitions: old places are left, crashes are mended, reruns change nothing."""

from datetime import date

import pytest
from conftest import rows

from costlake.plans.ingest import ingest
from costlake.sources import keyed
from costlake.sources.keyed import finish_moves, index_path, load_keyed
from costlake.sources.schemas import LANDING_TABLES
from costlake.sources.storage import exists, names

SCHEMA = "id string, month date, amount double"
MAY, JUNE, JULY = date(2025, 5, 1), date(2025, 6, 1), date(2025, 7, 1)


def load(spark, path, *values):
    return load_keyed(spark.createDataFrame(list(values), SCHEMA), path, ["id"], "month")


def table(spark, path):
    return rows(spark.read.schema(SCHEMA).parquet(path).select("id", "month", "amount"))


def test_a_moved_key_leaves_its_old_partition(spark, folder):
    path = f"{folder}/t"
    assert load(spark, path, ("a", JUNE, 1.0), ("b", JUNE, 2.0), ("c", MAY, 3.0)) == 0
    assert load(spark, path, ("a", JULY, 9.0), ("d", JULY, 4.0)) == 1
    expected = [("a", JULY, 9.0), ("b", JUNE, 2.0), ("c", MAY, 3.0), ("d", JULY, 4.0)]
    assert table(spark, path) == expected
    assert load(spark, path, ("a", JULY, 9.0), ("d", JULY, 4.0)) == 0
    assert table(spark, path) == expected
    # And back again; July is replaced by what the load brings, June is merged.
    assert load(spark, path, ("b", MAY, 5.0)) == 1
    assert table(spark, path) == [("a", JULY, 9.0), ("b", MAY, 5.0), ("d", JULY, 4.0)]
    assert not exists(spark, f"{path}/month=2025-06-01")
    assert names(spark, folder, "t__") == ["t__keys"]


def test_brought_partitions_are_still_replaced_whole(spark, folder):
    path = f"{folder}/t"
    load(spark, path, ("a", JUNE, 1.0), ("b", JUNE, 2.0))
    assert load(spark, path, ("b", JUNE, 3.0)) == 0
    assert table(spark, path) == [("b", JUNE, 3.0)]


def test_a_table_from_before_the_index_gets_one(spark, folder):
    path = f"{folder}/t"
    old = spark.createDataFrame([("a", JUNE, 1.0), ("b", JUNE, 2.0)], SCHEMA)
    old.write.partitionBy("month").parquet(path)
    assert load(spark, path, ("a", JULY, 1.0)) == 1
    assert table(spark, path) == [("a", JULY, 1.0), ("b", JUNE, 2.0)]


@pytest.mark.parametrize("step", ["write_partitions", "remove", "_add_entries", "_finish_index"])
@pytest.mark.parametrize("call", [1, 2, 3])
def test_a_crash_at_any_step_is_mended_by_the_next_load(spark, folder, monkeypatch, step, call):
    path = f"{folder}/t"
    load(spark, path, ("a", JUNE, 1.0), ("b", JUNE, 2.0), ("c", MAY, 3.0))
    done, calls = getattr(keyed, step), []

    def fail(*args, **kwargs):
        calls.append(args)
        if len(calls) == call:
            raise RuntimeError("lost driver")
        return done(*args, **kwargs)

    monkeypatch.setattr(keyed, step, fail)
    moved = [("a", JULY, 9.0), ("c", JULY, 8.0)]
    try:
        load(spark, path, *moved)
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert load(spark, path, *moved) in (0, 2)
    assert table(spark, path) == [("a", JULY, 9.0), ("b", JUNE, 2.0), ("c", JULY, 8.0)]
    # The index names the new places: another move finds both.
    assert load(spark, path, ("a", MAY, 1.0), ("c", MAY, 1.0)) == 2
    assert table(spark, path) == [("a", MAY, 1.0), ("b", JUNE, 2.0), ("c", MAY, 1.0)]


def test_a_staged_load_is_published_without_a_new_one(spark, folder, monkeypatch):
    path = f"{folder}/t"
    load(spark, path, ("a", JUNE, 1.0))
    finish = keyed.finish_moves
    monkeypatch.setattr(keyed, "finish_moves", lambda *args: None)
    load(spark, path, ("a", JULY, 2.0))
    assert table(spark, path) == [("a", JUNE, 1.0)]
    monkeypatch.undo()
    finish_moves(spark, path, ["id"], "month", spark.read.schema(SCHEMA).parquet(path).schema)
    assert finish is keyed.finish_moves and table(spark, path) == [("a", JULY, 2.0)]


def test_the_index_reads_only_the_buckets_of_a_load(spark, folder):
    path = f"{folder}/t"
    load(spark, path, *[(f"k{i}", JUNE, 1.0) for i in range(200)])
    before = set(names(spark, f"{index_path(path)}/entries", "key_bucket="))
    assert len(before) == 8
    load(spark, path, ("k7", JULY, 1.0))
    assert set(names(spark, f"{index_path(path)}/entries", "key_bucket=")) == before
    assert len(table(spark, path)) == 200


def land(folder, *lines):
    header = "invoice_id,org_id,month,subtotal,credits,taxes,currency,exchange_rate_to_usd"
    with open(f"{folder}/billing_monthly.csv", "w") as out:
        out.write("\n".join([header, *lines]))


def test_an_invoice_that_lands_again_under_another_month_counts_once(spark, folder):
    land(folder, "inv1,o1,2025-06-01,10,,,USD,1", "inv2,o1,2025-06-01,20,,,USD,1")
    ingest(spark, folder, f"{folder}/bronze", "2026-06-14", "billing_monthly")
    land(folder, "inv1,o1,2025-07-01,10,,,USD,1")
    stats = ingest(spark, folder, f"{folder}/bronze", "2026-06-15", "billing_monthly")
    assert rows(stats, "table_name")[0] == ("billing_monthly", 1, 1, 1, 1)
    bronze = spark.read.parquet(f"{folder}/bronze/batch/billing_monthly")
    assert rows(bronze.select("invoice_id", "month")) == [("inv1", JULY), ("inv2", JUNE)]


def test_statistics_stay_as_they_were_when_landing_changes(spark, folder):
    land(folder, "inv1,o1,2025-06-01,10,,,USD,1")
    stats = ingest(spark, folder, f"{folder}/bronze", "2026-06-14", "billing_monthly")
    land(folder, *[f"inv{i},o1,2025-06-01,10,,,USD,1" for i in range(5)])
    assert rows(stats, "table_name")[0] == ("billing_monthly", 1, 1, 1, 1)


def test_loads_kept_by_date_are_history():
    assert [name for name, spec in LANDING_TABLES.items() if spec.may_move] == [
        "billing_monthly", "marketing_touches", "support_tickets",
    ]

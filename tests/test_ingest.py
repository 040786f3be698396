from datetime import date

import pytest

from conftest import rows
from costlake.plans.ingest import (
    check_batch_date,
    ingest,
    ingest_stats,
    select_tables,
    to_bronze,
    with_technical_columns,
)
from costlake.sources.readers import dry_run_count, read_landing
from costlake.sources.schemas import LANDING_TABLES
from costlake.sources.sinks import verify_counts

BILLING = LANDING_TABLES["billing_monthly"]
HEADER = "invoice_id,org_id,month,subtotal,credits,taxes,currency,exchange_rate_to_usd"


def land(folder, name, *lines):
    path = f"{folder}/{name}.csv"
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


def land_billing(folder):
    land(
        folder, "billing_monthly", HEADER,
        "i1,o1,2025-06-01,10.5,,2.1,USD,1.0",
        "i1,o1,2025-06-01,10.5,,2.1,USD,1.0",
        "i2,o1,2025-07-01,n/a,,,USD,",
        "i3,,2025-07-01,1,,,USD,1.0",
        "i4,o1,not-a-day,1,,,USD,1.0",
    )


def test_malformed_cells_are_null(spark, folder):
    land_billing(folder)
    got = {r.invoice_id: r for r in read_landing(spark, BILLING, folder).collect()}
    assert got["i2"].subtotal is None and got["i2"].exchange_rate_to_usd is None
    assert got["i4"].month is None
    assert got["i1"].source_file.endswith("billing_monthly.csv")


def test_ingest_counts_every_step_and_reruns_to_the_same_table(spark, folder):
    land_billing(folder)
    for _ in range(2):
        stats = ingest(spark, folder, f"{folder}/bronze", "2026-06-15", "billing_monthly")
        assert rows(stats, "table_name") == [
            ("billing_monthly", 5, 3, 2, 2),
            ("total", 5, 3, 2, 2),
        ]
        table = f"{folder}/bronze/batch/billing_monthly"
        counts = verify_counts(spark, {"billing": table, "absent": f"{folder}/none"})
        assert rows(counts, "table_name") == [("absent", None), ("billing", 2)]
        assert dry_run_count(spark, table, BILLING.schema) == 2
    got = spark.read.parquet(table)
    assert rows(got.select("batch_date", "load_date").distinct()) == [(date(2026, 6, 15),) * 2]


def test_every_table_has_its_partition_and_required_columns(spark, folder):
    for spec in select_tables():
        land(folder, spec.name, ",".join(spec.schema.fieldNames()))
        landed = with_technical_columns(read_landing(spark, spec, folder), "2026-06-15")
        assert {spec.partition_by, *spec.required, *spec.keys} <= set(landed.columns)
        assert ingest_stats(landed, spec).first().records_written == 0
        assert to_bronze(landed, spec).isEmpty()


def test_touch_date_comes_from_the_timestamp(spark, folder):
    spec = LANDING_TABLES["marketing_touches"]
    land(folder, spec.name, ",".join(spec.schema.fieldNames()), "t,o,c,ch,2025-07-01T23:30:00Z,True,False")
    row = with_technical_columns(read_landing(spark, spec, folder), "2026-06-15").first()
    assert (row.touch_date, row.clicked, row.converted) == (date(2025, 7, 1), True, False)


def test_wrong_arguments(spark, folder):
    assert [spec.name for spec in select_tables(" users , resources ")] == ["users", "resources"]
    with pytest.raises(ValueError, match="no_such"):
        select_tables("users,no_such")
    with pytest.raises(ValueError, match="2026-13-01"):
        check_batch_date("2026-13-01")
    with pytest.raises(FileNotFoundError, match="billing_monthly"):
        read_landing(spark, BILLING, folder)

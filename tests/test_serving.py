from datetime import date

from conftest import rows
from costlake.plans import serving
from costlake.sources.schemas import GOLD_MARTS, SERVING_TABLES

DAYS = [date(2025, 7, 18), date(2025, 7, 31), date(2025, 8, 1)]


def usage(spark):
    spec = SERVING_TABLES["org_daily_usage_by_service"]
    records = []
    for day in DAYS:
        for service, cost in [("api", 1.0), ("db", 5.0), ("genai", 5.0), ("vm", 0.5)]:
            values = {
                "org_id": "o", "month_bucket": day.strftime("%Y-%m"), "event_date": day,
                "service": service, "daily_cost_usd": cost, "requests": 2,
            }
            records.append(tuple(values.get(name) for name in spec.columns))
    return spark.createDataFrame(records, spec.schema)


def test_daily_costs_in_declared_order(spark):
    got = serving.daily_costs(usage(spark), "o", "2025-07", "2025-07-01", "2025-07-31").collect()
    assert [(r.event_date, r.service) for r in got] == [
        (day, service) for day in (DAYS[1], DAYS[0]) for service in ("api", "db", "genai", "vm")
    ]


def test_top_services_ranks_ties_by_name(spark):
    got = serving.top_services(usage(spark), "o", ["2025-07", "2025-08"], "2025-07-18", "2025-07-31", 3)
    assert rows(got, "rank") == [(1, "db", 10.0), (2, "genai", 10.0), (3, "api", 2.0)]


def test_rows_without_complete_keys_are_not_served(spark):
    mart = spark.createDataFrame(
        [(None, date(2025, 7, 1), 1, 0.0, None, {"low": 1}, "2025-07"),
         ("o", date(2025, 7, 1), 1, 0.0, None, {"low": 1}, "2025-07"),
         ("o", date(2025, 7, 2), 1, 0.0, 3.5, None, "2025-07")],
        GOLD_MARTS["tickets_by_org_date"],
    )
    served = serving.serving_rows(mart, "tickets_by_org_date")
    assert [f.dataType for f in served.schema] == [f.dataType for f in SERVING_TABLES["tickets_by_org_date"].schema]
    trend = serving.ticket_trend(served, "o", "2025-07", "2025-07-01", "2025-07-31").collect()
    assert [tuple(r) for r in trend] == [
        (date(2025, 7, 2), 1, 0.0, 3.5, None), (date(2025, 7, 1), 1, 0.0, None, {"low": 1}),
    ]


def test_tokens_of_several_services_are_summed(spark):
    mart = spark.createDataFrame(
        [("o", "2025-07", date(2025, 7, 1), 5, 1.5), ("o", "2025-07", date(2025, 7, 1), 0, 2.0)],
        GOLD_MARTS["genai_tokens_by_org_date"],
    )
    served = serving.serving_rows(mart, "genai_tokens_by_org_date")
    assert rows(serving.genai_use(served, "o", "2025-07", "2025-07-01", "2025-07-31")) == [
        ("o", "2025-07", date(2025, 7, 1), 5, 3.5)
    ]


def test_revenue_newest_month_first(spark):
    mart = spark.createDataFrame(
        [("o", m, 1.0, 0.0, 0.0, 1.0, 1.0) for m in ("2025-06-01", "2025-08-01", "2025-07-01")],
        GOLD_MARTS["revenue_by_org_month"],
    )
    got = serving.monthly_revenue(mart, "o").collect()
    assert [r.month for r in got] == ["2025-08-01", "2025-07-01", "2025-06-01"]


def test_preview(spark):
    shown, total = serving.preview(spark.range(50))
    assert (shown.count(), total) == (20, 50)

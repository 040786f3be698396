from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from costlake.plans.finance import normalise_billing, revenue_by_org_month, split_billing

SCHEMA = """invoice_id STRING, org_id STRING, month STRING, subtotal DOUBLE, credits DOUBLE,
    taxes DOUBLE, currency STRING, exchange_rate_to_usd DOUBLE"""


def invoices(spark, *records):
    return spark.createDataFrame(records, SCHEMA).selectExpr(
        "invoice_id", "org_id", "CAST(month AS DATE) AS month", "subtotal", "credits", "taxes",
        "currency", "exchange_rate_to_usd",
    )


def invoice(key, subtotal, org="o", month="2025-06-01", credits=None, taxes=None, rate=1.0):
    return (key, org, month, subtotal, credits, taxes, "USD", rate)


def test_unknown_revenue_is_rejected_not_lost(spark):
    df = invoices(spark, *[invoice(str(i), v) for i, v in enumerate([10.0, -10.0, None, 0.0])])
    valid, rejected = split_billing(df)
    assert rows(valid.select("invoice_id")) == [("0",)]
    assert rows(rejected.select("invoice_id")) == [("1",), ("2",), ("3",)]


def test_missing_rate_and_amounts(spark):
    df = normalise_billing(invoices(spark, invoice("a", 10.0, rate=None), invoice("b", 10.0, rate=2.0)))
    got = rows(df.select("invoice_id", "revenue_usd", "credits_usd", "taxes_usd", "fx_applied"))
    assert got == [("a", 10.0, 0.0, 0.0, 1.0), ("b", 20.0, 0.0, 0.0, 2.0)]


def test_golden_months(spark):
    df = invoices(
        spark,
        invoice("a", 1133.34, month="2025-06-01", taxes=238.0, rate=0.97684),
        invoice("b", 619.17, month="2025-07-01", taxes=130.03, rate=1.00331),
        invoice("c", 540.79, month="2025-08-01", taxes=113.57, rate=0.0016),
    )
    mart = revenue_by_org_month(split_billing(df)[0])
    got = rows(mart.selectExpr("CAST(month AS STRING)", "revenue_usd", "taxes_usd", "net_revenue_usd"))
    assert got == [
        ("2025-06-01", 1107.091846, 232.48792, 1339.579766),
        ("2025-07-01", 621.219453, 130.460399, 751.679852),
        ("2025-08-01", 0.865264, 0.181712, 1.046976),
    ]


def test_net_revenue_uses_unrounded_sums(spark):
    df = invoices(
        spark, *[invoice(str(i), 1.0000004, credits=0.0000004, taxes=0.0) for i in range(3)]
    )
    mart = revenue_by_org_month(split_billing(df)[0]).first()
    assert (mart.revenue_usd, mart.credits_usd, mart.net_revenue_usd) == (3.000001, 0.000001, 3.0)


maybe = st.one_of(st.none(), st.sampled_from([-5.0, 0.0, 2.5]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from([None, "o"]), st.sampled_from([None, "2025-06-01"]), maybe, maybe),
        min_size=1, max_size=20,
    )
)
def test_split_is_complete(spark, cases):
    df = invoices(
        spark,
        *[
            invoice(str(i), subtotal, org=org, month=month, rate=rate)
            for i, (org, month, subtotal, rate) in enumerate(cases)
        ],
    )
    valid, rejected = split_billing(df)
    ids = [r.invoice_id for part in (valid, rejected) for r in part.select("invoice_id").collect()]
    assert sorted(ids, key=int) == [str(i) for i in range(len(cases))]

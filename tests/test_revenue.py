import datetime

from pyspark.sql import functions as F

from recurra.operators import revenue
from recurra.operators.validation import enrich_events, split_events
from recurra.sources import fixtures
from tests.rows import SIX_EVENTS, collected, enriched, event, events

SF = "/root/testdata/sf0.001"


def tenants(spark, ids):
    rows = [(i, f"Company {i}", "Tech", "growth", "India", "2024-01-01") for i in ids]
    return spark.createDataFrame(rows, "tenant_id string, company_name string, industry string, plan string, country string, signup_date string")


def test_six_rows(spark):
    mrr = revenue.monthly_mrr(enrich_events(split_events(events(spark, SIX_EVENTS))[0]))
    february = collected(revenue.global_mrr(mrr), "period")[0]
    assert (february["total_mrr"], february["total_arr"], february["paying_tenants"]) == (9485, 9485 * 12, 3)
    first = collected(mrr.filter("tenant_id = 'TNT_ADA'"), "period")
    assert [r["mrr"] for r in first] == [410, 410] and first[1]["mrr_growth_pct"] == 0.0


def test_windows_go_by_rows_not_by_calendar(spark):
    rows = [
        event(1, "T", "invoice_paid", "2024-01-05", amount=100),
        event(2, "T", "invoice_paid", "2024-01-09", amount=100, invoice=None),
        event(3, "T", "invoice_paid", "2024-04-05", amount=0),
        event(4, "T", "invoice_paid", "2024-09-05", amount=50),
        event(5, "T", "invoice_paid", "2025-01-05", amount=75),
        event(6, "T", "invoice_paid", "2025-01-06", amount=999, status="pending"),
    ]
    got = collected(revenue.monthly_mrr(enriched(spark, rows)), "period")
    assert [r["period"] for r in got] == ["2024-01", "2024-04", "2024-09", "2025-01"]
    assert [r["prev_mrr"] for r in got] == [None, 200, 0, 50]
    assert [r["mrr_growth_pct"] for r in got] == [None, -100.0, None, 50.0]
    assert [r["cumulative_mrr"] for r in got] == [200, 200, 250, 325]
    assert [r["rolling_3m_mrr"] for r in got] == [200.0, 100.0, 250 / 3, 125 / 3]
    assert got[0]["invoice_count"] == 1


def test_total_ignores_status(spark):
    rows = [
        event(1, "T", "invoice_paid", "2024-01-05", amount=10),
        event(2, "T", "invoice_paid", "2024-01-06", amount=5, status="pending"),
        event(3, "T", "invoice_failed", "2024-01-06", amount=7),
    ]
    assert revenue.paid_total(enriched(spark, rows)).first().mrr_total == 15


def test_ltv_drops_unknown_tenants_and_breaks_ties_by_id(spark):
    rows = [event(n, t, "invoice_paid", "2024-01-05") for n, t in enumerate(["B", "A", "C", "unknown"])]
    ltv = revenue.tenant_ltv(revenue.monthly_mrr(enriched(spark, rows)), tenants(spark, "ABCD"))
    assert [r.tenant_id for r in revenue.top_by_ltv(ltv, 2).collect()] == ["A", "B"]
    assert ltv.count() == 3


def test_conservation_on_shared_tables(spark):
    clean = split_events(fixtures.raw_events(spark, SF))[0]
    mrr = revenue.monthly_mrr(enrich_events(clean))
    tenant_sum = mrr.agg(F.sum("mrr")).first()[0]
    assert revenue.global_mrr(mrr).agg(F.sum("total_mrr")).first()[0] == tenant_sum
    assert revenue.latest_tenant_mrr(mrr).agg(F.sum("cumulative_mrr")).first()[0] == tenant_sum
    assert mrr.count() == 983 and clean.count() == 1468


def test_invoice_view(spark):
    day = datetime.date(2024, 3, 31)
    rows = [("I1", "A", 10, "paid", day), ("I2", "A", 20, "paid", day), ("I3", "A", 9, "failed", day), ("I4", "Z", 5, "paid", day)]
    invoices = spark.createDataFrame(rows, "invoice_id string, tenant_id string, amount int, status string, billing_date date")
    view = revenue.monthly_revenue_view(invoices, tenants(spark, "AB"))
    assert collected(view, "tenant_id") == [
        {
            "tenant_id": "A", "company_name": "Company A", "industry": "Tech", "plan": "growth", "country": "India",
            "billing_month": datetime.date(2024, 3, 1), "invoice_count": 2, "total_mrr": 30, "arr": 360,
            "avg_invoice_amount": 15.0,
        }
    ]
    assert [r.lifetime_value for r in revenue.top_lifetime_revenue(view).collect()] == [30]
    assert revenue.tenant_revenue_trend(view, "B").count() == 0

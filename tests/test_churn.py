import datetime

import pytest

from recurra import schemas
from recurra.operators import churn
from tests.rows import collected, enriched, event


@pytest.fixture
def churn_table(spark):
    rows = [
        (2025, 3, "2025-03", "starter", 10, 2, 20.0),
        (2025, 3, "2025-03", "growth", 20, 0, 0.0),
        (2025, 4, "2025-04", "starter", 10, 0, 0.0),
        (2025, 4, "2025-04", "growth", 20, 0, 0.0),
    ]
    return spark.createDataFrame(rows, schemas.CHURN)


@pytest.fixture
def text_dated_events(spark):
    rows = [("TNT_001", "subscription_cancelled", "2025-03-12"), ("TNT_002", "invoice_failed", "2025-04-01")]
    return spark.createDataFrame(rows, "tenant_id string, event_type string, event_date string")


def test_report_picks_the_latest_month_with_churn(spark, churn_table, text_dated_events):
    row = churn.churn_kpis(churn_table, text_dated_events).first()
    assert (row.selected_period, row.overall_churn_label, row.churned_in_period) == ("2025-03", "6.7%", 2)
    assert (row.highest_plan, row.lowest_plan, row.all_time_cancelled) == ("Starter", "Growth", 1)
    assert churn.latest_churn_period(churn_table).first()[0] == "2025-03"


def test_report_without_any_churn_takes_the_latest_month(spark, churn_table, text_dated_events):
    calm = churn_table.filter("churned_tenants = 0")
    row = churn.churn_kpis(calm, text_dated_events).first()
    # All rates tie at zero: the first plan by name wins on both ends.
    assert (row.selected_period, row.highest_plan, row.lowest_plan) == ("2025-04", "Growth", "Growth")
    assert churn.churn_kpis(calm.limit(0), text_dated_events).count() == 0


def test_plan_list_fills_absent_plans(spark, churn_table):
    got = collected(churn.plan_churn(churn_table), "plan")
    assert [(r["plan"], r["rate_label"], r["bar_width"]) for r in got] == [
        ("Business", "0.0%", 0),
        ("Enterprise", "0.0%", 0),
        ("Growth", "0.0%", 0),
        ("Starter", "20.0%", 100),
    ]


def test_rate_uses_payers_of_the_same_month_and_event_plan(spark):
    rows = [
        event(1, "A", "invoice_paid", "2024-01-01", plan="growth"),
        event(2, "A", "invoice_paid", "2024-01-02", plan="growth", status="pending"),
        event(3, "A", "invoice_paid", "2024-01-03", plan="starter"),
        event(4, "B", "invoice_paid", "2024-01-03", plan="growth"),
        event(5, "C", "invoice_paid", "2024-01-03", plan="growth"),
        event(6, "C", "subscription_cancelled", "2024-01-04", plan="growth"),
        event(7, "C", "subscription_cancelled", "2024-01-05", plan="growth"),
        event(8, "D", "subscription_cancelled", "2024-02-05", plan="growth"),
        event(9, "E", "invoice_paid", "2024-01-05", plan=None),
        event(10, "E", "subscription_cancelled", "2024-01-05", plan=None),
    ]
    table = churn.churn_by_plan(enriched(spark, rows))
    got = {r["plan"]: (r["active_tenants"], r["churned_tenants"], r["churn_rate_pct"]) for r in collected(table, "plan")}
    # February has a cancellation but no payer; a NULL plan never joins.
    assert got == {"growth": (3, 1, 33.33), "starter": (1, 0, 0.0), None: (1, 0, 0.0)}
    totals = churn.churn_by_period(table).first()
    assert totals.active_tenants == 5  # A counts under both plans
    assert churn.churn_in_month(table, 6).count() == 0
    assert churn.active_tenants(enriched(spark, rows)).count() == 3
    assert churn.churned_tenants(enriched(spark, rows)).count() == 3


def test_billing_risk_on_text_dates(spark, text_dated_events):
    known = spark.createDataFrame([("TNT_002", "Acme Analytics")], "tenant_id string, company_name string")
    row = churn.billing_risk(text_dated_events, known).first()
    assert (row.company_name, row.reason) == ("Acme Analytics", "1 failed invoice in last 90d")


def test_billing_risk_takes_the_top_before_dropping_unknown_tenants(spark):
    rows = [event(f"{t}{n}", t, "invoice_failed", "2024-06-01") for t, k in zip("ABCDEF", (3, 3, 2, 1, 1, 1)) for n in range(k)]
    rows.append(event("old", "F", "invoice_failed", "2024-01-01"))
    rows.append(event("edge", "E", "invoice_failed", "2024-03-31"))
    rows.append(event("last", "Z", "trial_started", "2024-06-29"))
    known = spark.createDataFrame([(t, t) for t in "ACEF"], "tenant_id string, company_name string")
    got = collected(churn.billing_risk(enriched(spark, rows), known), "tenant_id")
    # Counts: A 3, B 3, C 2, E 2 (the edge is inside), D 1, F 1; B is unknown.
    assert [(r["tenant_id"], r["failure_count"]) for r in got] == [("A", 3), ("C", 2), ("E", 2)]
    assert got[0]["color"].endswith("danger)") and got[1]["color"].endswith("warning)")


def test_billing_risk_without_dates_has_no_cutoff(spark):
    rows = [event(1, "A", "invoice_failed", None)]
    known = spark.createDataFrame([("A", "A")], "tenant_id string, company_name string")
    assert churn.billing_risk(enriched(spark, rows), known).count() == 1


def test_churn_candidates_at_the_bound(spark):
    tenants = spark.createDataFrame([(t, t) for t in "ABCD"], "tenant_id string, company_name string")
    day = datetime.date
    rows = [
        ("A", "paid", day(2024, 3, 1)),
        ("A", "failed", day(2024, 4, 30)),
        ("B", "paid", day(2024, 2, 29)),
        ("C", "pending", day(2024, 4, 30)),
    ]
    invoices = spark.createDataFrame(rows, "tenant_id string, status string, billing_date date")
    got = collected(churn.churn_candidates(tenants, invoices), "tenant_id")
    # 60 days before April 30 is March 1, which is not older yet.
    assert [(r["tenant_id"], r["last_payment"]) for r in got] == [("B", day(2024, 2, 29)), ("C", None), ("D", None)]

import pytest

from recurra import schemas
from recurra.operators import fallback, inventory, overview, portfolio, revenue
from recurra.operators.access import tenant_scope
from recurra.operators.churn import billing_risk, churn_by_plan
from recurra.sources.files import load_or_empty
from tests.rows import collected, enriched, event
from tests.test_revenue import tenants

ROWS = [
    event(1, "A", "invoice_paid", "2024-01-05", amount=1000),
    event(2, "B", "invoice_paid", "2024-01-05", amount=500),
    event(3, "A", "invoice_paid", "2024-02-05", amount=1500),
    event(4, "A", "subscription_cancelled", "2024-02-06"),
    event(5, "C", "invoice_paid", "2024-02-07", amount=0),
]


@pytest.fixture
def events(spark):
    return enriched(spark, ROWS)


@pytest.fixture
def mrr(events):
    return revenue.monthly_mrr(events)


@pytest.fixture
def ltv(spark, mrr):
    return revenue.tenant_ltv(mrr, tenants(spark, "ABC"))


def test_kpis_compare_with_the_previous_month(spark, events, mrr):
    kpis = overview.overview_kpis(revenue.global_mrr(mrr), churn_by_plan(events))
    row = kpis.first()
    assert (row.period, row.total_mrr, row.mrr_change_pct, row.churn_pct) == ("2024-02", 1500, 0.0, 50.0)
    labels = {r["label"]: (r["value"], r["trend_text"], r["trend_class"]) for r in collected(overview.overview_labels(kpis), "label")}
    assert labels["Churn Rate"] == ("50.0%", "+50.0% vs last mo", "dn")
    assert labels["Active Tenants"] == ("2", "+0 this month", "up")
    assert labels["Total MRR"] == ("INR 1.5k", "0.0%", "neutral")


def test_kpis_of_a_single_month_compare_with_themselves(spark, events, mrr):
    one = revenue.global_mrr(mrr).filter("period = '2024-01'")
    row = overview.overview_kpis(one, churn_by_plan(events)).first()
    assert (row.mrr_change_pct, row.paying_tenants_change, row.churn_change) == (0.0, 0, 0.0)


def test_kpis_without_churn_table_or_without_data(spark, mrr, tmp_path):
    absent = load_or_empty(spark, str(tmp_path / "nothing"), schemas.CHURN)
    kpis = overview.overview_kpis(revenue.global_mrr(mrr), absent)
    labels = {r["label"]: r for r in collected(overview.overview_labels(kpis), "label")}
    assert (labels["Churn Rate"]["value"], labels["Churn Rate"]["trend_text"]) == ("0.0%", "-")
    assert overview.overview_kpis(revenue.global_mrr(mrr.limit(0)), absent).count() == 0


def test_trend_windows(spark):
    rows = [event(n, "A", "invoice_paid", f"2024-{n:02d}-05", amount=n * 100) for n in range(1, 10)]
    monthly = revenue.global_mrr(revenue.monthly_mrr(enriched(spark, rows)))
    half = collected(overview.mrr_trend(monthly, "6m"), "period")
    assert [r["month_name"] for r in half] == ["Apr", "May", "Jun", "Jul", "Aug", "Sep"]
    assert [r["pct_height"] for r in half] == [40, 50, 60, 70, 80, 90]
    assert overview.mrr_trend(monthly, "1y").count() == 9 == overview.mrr_trend(monthly, "all").count()
    flat = monthly.withColumn("total_mrr", monthly.total_mrr * 0)
    assert {r.pct_height for r in overview.mrr_trend(flat, "6m").collect()} == {0}


def test_revenue_by_plan_uses_the_tenant_plan_and_latest_month(spark, mrr):
    dim = tenants(spark, "BC").unionByName(tenants(spark, "A").replace("growth", "enterprise", ["plan"]))
    got = overview.revenue_by_plan(mrr, dim).collect()
    assert [(r.plan, r.raw_mrr, r.pct, r.tier) for r in got] == [("Enterprise", 1500, 100, 4), ("Growth", 0, 0, 2)]
    # Tenants without a known plan are left out, and take no share.
    assert [r.raw_mrr for r in overview.revenue_by_plan(mrr, tenants(spark, "BC")).collect()] == [0]


def test_empty_reports_fall_back(spark, events, mrr, ltv):
    full = overview.revenue_by_plan(mrr, tenants(spark, "ABC"))
    assert fallback.revenue_by_plan_or_zero(full).collect() == full.collect()
    zero = collected(fallback.revenue_by_plan_or_zero(full.limit(0)), "tier")
    assert [(r["plan"], r["mrr"], r["pct"]) for r in zero] == [(p, "INR 0", 0) for p in ("Starter", "Growth", "Business", "Enterprise")]
    notice = fallback.billing_risk_or_notice(billing_risk(events, ltv)).collect()
    assert [r.company_name for r in notice] == ["No high-risk accounts found"]


def test_top_tenants_show_their_own_latest_month(ltv, mrr):
    got = collected(overview.top_tenants(ltv, mrr, 2), "tenant_id")
    assert [(r["tenant_id"], r["latest_mrr"], r["mom_growth"]) for r in got] == [("A", 1500, "+50.0%"), ("B", 500, "-")]


def test_standing_in_one_pass_equals_status_of_stored_tables(spark, ltv, mrr):
    one_pass, of_tables = portfolio.tenant_standing(mrr, tenants(spark, "ABC")), portfolio.tenant_status(ltv, mrr)
    assert one_pass.columns == of_tables.columns
    assert collected(one_pass, "tenant_id") == collected(of_tables, "tenant_id")
    assert portfolio.tenant_standing(mrr.limit(0), tenants(spark, "ABC")).count() == 0


def test_status_portfolio_and_page(ltv, mrr):
    status = portfolio.tenant_status(ltv, mrr)
    assert {r.tenant_id: r.status for r in status.collect()} == {"A": "Active", "B": "Churned", "C": "Active"}
    row = portfolio.tenant_portfolio(status).first()
    assert (row.total_count, row.active_count, row.avg_ltv) == (3, 2, 1000.0)
    page = portfolio.tenant_page(status, page=1, limit=2).collect()
    assert [(r.tenant_id, r.mrr, r.total_filtered) for r in page] == [("A", "INR 1.5k", 3), ("B", "INR 500", 3)]
    # C paid nothing in the latest month, so its average is shown.
    assert [(r.tenant_id, r.mrr) for r in portfolio.tenant_page(status, page=2, limit=2).collect()] == [("C", "INR 0")]
    assert portfolio.tenant_page(status, page=9).count() == 0


def test_search(spark):
    rows = [("T1", "Acme (North)", "Growth"), ("T2", "beta", "starter"), ("acme3", None, "growth"), ("T4", None, None)]
    df = spark.createDataFrame(rows, "tenant_id string, company_name string, plan string")

    def found(**options):
        return [r["tenant_id"] for r in collected(portfolio.tenant_search(df, **options), "tenant_id")]

    assert found(search="ACME") == ["T1", "acme3"]
    assert found(search="^b.t") == ["T2"]
    assert found(search="(north)", literal=True) == ["T1"]
    assert found(search="acme", plan="GROWTH") == ["T1", "acme3"]
    assert found(plan="starter") == ["T2"]
    assert found() == ["T1", "T2", "T4", "acme3"]


def test_inventory_of_empty_and_filled_tables(events, ltv):
    retention = ltv.selectExpr("'2024-01' AS cohort")
    got = {r.dataset: (r.items, r.status) for r in inventory.dataset_inventory(events, events.limit(0), ltv, retention).collect()}
    assert got == {"clean_events": (5, "st-ok"), "rejected_rows": (0, "st-idle"), "paying_tenants": (3, "st-ok"), "cohorts": (1, "st-ok")}


def test_scope(mrr):
    assert tenant_scope(mrr, "A").count() == 2
    assert tenant_scope(mrr, None).count() == 0

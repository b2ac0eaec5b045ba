import random

from recurra import schemas
from recurra.operators import projection
from tests.rows import collected
from tests.test_functions import python_inr


def project(tenants, arpu, growth, churn, months):
    """The month-by-month definition in plain Python."""
    g, c, now, rows = growth / 100, churn / 100, float(tenants), []
    for month in range(1, months + 1):
        start = now
        added, lost = max(start * g, -start), start * c
        now = max(start + added - lost, 0)
        rows.append(
            (month, round(start, 1), round(added, 1), round(lost, 1), round(now, 1), round(now * arpu, 2),
             python_inr(now * arpu), python_inr(now * arpu * 12))
        )
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(f"S{i:04d}", *r) for i, r in enumerate(rows)], schemas.SCENARIOS)


def test_growth_and_churn(spark):
    scenario = frame(spark, [(100, 1000.0, 10.0, 5.0, 2)])
    summary = projection.projection_summary(scenario).first()
    assert summary.starting_mrr == "INR 1.00L"
    assert summary.ending_tenants == 110.2
    assert summary.ending_mrr == "INR 1.10L"
    assert projection.revenue_projection(scenario).count() == 2


def test_full_churn(spark):
    summary = projection.projection_summary(frame(spark, [(10, 500.0, 0.0, 100.0, 1)])).first()
    assert (summary.ending_tenants, summary.ending_mrr) == (0, "INR 0")
    assert (summary.mrr_change, summary.mrr_change_pct) == ("INR -5000", -100.0)


def test_free_plan_has_no_change(spark):
    summary = projection.projection_summary(frame(spark, [(10, 0.0, 5.0, 1.0, 3)])).first()
    assert (summary.starting_mrr, summary.mrr_change_pct) == ("INR 0", 0.0)


def test_matches_the_monthly_loop(spark):
    rng = random.Random(11)
    rows = [
        (rng.randint(1, 100_000), rng.choice([99.5, 1000.0, rng.uniform(0, 1e5)]), rng.choice([-100.0, 0.0, 4.0, rng.uniform(-100, 60)]),
         rng.choice([0.0, 8.0, 100.0, rng.uniform(0, 100)]), rng.randint(1, 36))
        for _ in range(150)
    ]
    got = {}
    for r in projection.revenue_projection(frame(spark, rows)).collect():
        got.setdefault(r.scenario_id, []).append(tuple(r)[1:])
    for i, scenario in enumerate(rows):
        assert sorted(got[f"S{i:04d}"]) == project(*scenario)


def test_range_checks_name_the_first_bad_input(spark):
    rows = [
        (0, -1.0, 0.0, 0.0, 1),
        (1, 1e7 + 1, 300.0, 0.0, 1),
        (1, 1.0, -101.0, 0.0, 1),
        (1, 1.0, 0.0, float("nan"), 1),
        (1, 1.0, 0.0, 0.0, 37),
        (None, 1.0, 0.0, 0.0, 1),
        (100_000, 1e7, 200.0, 100.0, 36),
    ]
    valid, rejected = projection.split_scenarios(frame(spark, rows))
    assert [r["scenario_id"] for r in collected(valid, "scenario_id")] == ["S0006"]
    assert [r["scenario_error"].split()[0] for r in collected(rejected, "scenario_id")] == [
        "starting_tenants", "monthly_arpu", "monthly_growth_pct", "monthly_churn_pct", "months", "starting_tenants",
    ]


def test_seeded_scenarios_pass_the_same_ranges(spark):
    mrr = spark.createDataFrame(
        [("A", 2024, 1, "2024-01", 500), ("B", 2024, 1, "2024-01", 90_000_000)],
        "tenant_id string, event_year int, event_month int, period string, mrr long",
    )
    dim = spark.createDataFrame([("A", "growth"), ("B", "starter")], "tenant_id string, plan string")
    rates = spark.createDataFrame([("Growth", 2.0), ("Starter", 1.0)], "plan string, churn_rate_pct double")
    valid, rejected = projection.seeded_scenarios(mrr, dim, rates)
    assert [r.scenario_id for r in valid.collect()] == ["Growth"]
    assert [(r.scenario_id, r.scenario_error) for r in rejected.collect()] == [("Starter", "monthly_arpu out of range")]
    valid, rejected = projection.seeded_scenarios(mrr, dim, rates, growth_pct=900.0)
    assert valid.count() == 0 and rejected.count() == 2

from recurra.operators import cohorts
from recurra.operators.validation import enrich_events, split_events
from recurra.sources import fixtures
from tests.rows import collected, enriched, event

SF = "/root/testdata/sf0.01"

ROWS = [
    event(1, "A", "subscription_created", "2024-01-31"),
    event(2, "A", "subscription_created", "2024-05-01"),
    event(3, "B", "subscription_created", "2024-01-01"),
    event(4, "B", "subscription_cancelled", "2024-01-20"),  # in the signup month
    event(5, "C", "subscription_created", "2024-01-10"),
    event(6, "C", "subscription_cancelled", "2024-04-02"),
    event(7, "C", "subscription_cancelled", "2024-09-02"),  # the first one is final
    event(8, "D", "subscription_created", "2024-01-10"),
    event(9, "D", "subscription_cancelled", "2023-11-10"),  # before signup
    event(10, "E", "subscription_cancelled", "2024-02-10"),  # never signed up
]


def test_retention_by_hand(spark):
    events = enriched(spark, ROWS)
    got = collected(cohorts.cohort_retention(events), "months_since_start")
    assert [r["retained_tenants"] for r in got] == [4, 2, 2] + [1] * 9
    assert [r["retention_pct"] for r in got] == [100.0, 50.0, 50.0] + [25.0] * 9
    assert {r["cohort"] for r in got} == {"2024-01"} and {r["cohort_size"] for r in got} == {4}
    assert cohorts.cohort_sizes(events).first().cohort_size == 4
    assert [r["tenant_id"] for r in collected(cohorts.first_cancellation(events), "tenant_id")] == list("BCDE")
    assert cohorts.retention_head(cohorts.cohort_retention(events), 5).count() == 5


def test_offsets_without_survivors_are_absent_and_become_null(spark):
    events = enriched(spark, [ROWS[2], ROWS[3]])
    retention = cohorts.cohort_retention(events)
    assert retention.count() == 1
    matrix = cohorts.cohort_matrix(retention, cohorts.cohort_sizes(events))
    row = matrix.first()
    assert (row.cohort_size, row.M0, row.M1, row.M11) == (1, 100.0, None, None)
    assert cohorts.retention_lists(matrix).first().retention == [100.0] + [None] * 11


def test_matrix_default_size(spark):
    events = enriched(spark, ROWS)
    none = cohorts.cohort_sizes(events).limit(0)
    assert cohorts.cohort_matrix(cohorts.cohort_retention(events), none).first().cohort_size == 25


def test_retention_starts_full_and_never_rises(spark):
    events = enrich_events(split_events(fixtures.raw_events(spark, SF))[0])
    table = {}
    for r in cohorts.cohort_retention(events).collect():
        table.setdefault(r.cohort, {})[r.months_since_start] = r.retained_tenants
        assert r.retained_tenants <= r.cohort_size
        assert r.months_since_start or r.retention_pct == 100.0
    for by_offset in table.values():
        counts = [by_offset.get(m, 0) for m in range(12)]
        assert counts == sorted(counts, reverse=True)

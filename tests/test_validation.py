from recurra.operators.validation import enrich_events, rejection_summary, split_events
from tests.rows import SIX_EVENTS, collected, events

ODD = [
    (None, None, "nonsense", "starter", -1, "INR", None, "success", None, 1, False),
    ("E1", None, "nonsense", "starter", -1, "INR", None, "success", None, 1, False),
    ("E2", "T", "nonsense", "starter", -1, "INR", None, "success", None, 1, False),
    ("E3", "T", "invoice_paid", "starter", -1, "INR", None, "success", None, 1, False),
    ("E4", "T", "invoice_paid", "starter", 1, "INR", None, "success", None, 1, False),
    ("E5", "T", None, "no such plan", None, "INR", "2024-01-01 00:00:00", "success", None, 1, False),
]


def test_first_broken_rule_wins_and_nothing_is_lost(spark):
    clean, rejected = split_events(events(spark, ODD))
    assert [r["event_id"] for r in collected(clean, "event_id")] == ["E5"]
    assert {r["event_id"]: r["validation_error"] for r in collected(rejected, "event_id")} == {
        None: "missing event_id",
        "E1": "missing tenant_id",
        "E2": "invalid event_type",
        "E3": "negative amount",
        "E4": "null event_date",
    }


def test_null_type_and_null_amount_pass(spark):
    clean, _ = split_events(events(spark, ODD[-1:]))
    row = enrich_events(clean).first()
    assert row.event_year == 2024 and row.is_revenue_event is None


def test_six_rows(spark):
    clean, rejected = split_events(events(spark, SIX_EVENTS))
    assert clean.count() == 5
    assert collected(rejection_summary(rejected), "validation_error") == [
        {"validation_error": "negative amount", "rejected_rows": 1}
    ]
    rich = enrich_events(clean)
    assert rich.filter("is_churn_event").count() == 1
    assert enrich_events(events(spark, SIX_EVENTS)).filter("event_month = 2").count() == 4

"""Literal billing rows for unit tests."""

import datetime

from recurra import schemas
from recurra.operators.validation import enrich_events

# Rows for the rules: a tenant over two months that cancels, two more payers, one broken amount.
SIX_EVENTS = [
    ("EVT_A1", "TNT_ADA", "invoice_paid", "growth", 410, "INR", "2024-02-03 08:30:00", "success", "INV_A1", 4, False),
    ("EVT_A2", "TNT_ADA", "invoice_paid", "growth", 410, "INR", "2024-03-03 08:30:00", "success", "INV_A2", 4, False),
    ("EVT_B1", "TNT_BOB", "invoice_paid", "starter", 75, "INR", "2024-02-11 19:00:00", "success", "INV_B1", 1, True),
    ("EVT_A3", "TNT_ADA", "subscription_cancelled", "growth", 0, "INR", "2024-05-20 23:59:59", "success", None, 4, False),
    ("EVT_C1", "TNT_CYD", "invoice_paid", "enterprise", 9000, "INR", "2024-02-28 00:00:00", "success", "INV_C1", 30, False),
    ("EVT_D1", "TNT_DEE", "invoice_paid", "custom", -5, "INR", "2024-02-14 12:00:00", "success", "INV_D1", 2, False),
]


def moment(text):
    return datetime.datetime.fromisoformat(text) if text else None


def events(spark, rows):
    """Rows as given in ``SIX_EVENTS``."""
    return spark.createDataFrame([(*r[:6], moment(r[6]), *r[7:]) for r in rows], schemas.EVENTS)


def event(n, tenant, kind, date, plan="starter", amount=100, status="success", invoice="INV"):
    return (f"EVT_{n}", tenant, kind, plan, amount, "INR", date, status, invoice, 1, False)


def enriched(spark, rows):
    return enrich_events(events(spark, rows))


def collected(df, *order):
    """Rows as dicts, sorted."""
    return [r.asDict(recursive=True) for r in df.orderBy(*order).collect()]

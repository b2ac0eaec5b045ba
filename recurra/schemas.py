"""Table layouts and the fixed vocabulary of the billing domain."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# They must equal the billing system's own vocabulary.
EVENT_TYPES = [
    "subscription_created",
    "subscription_upgraded",
    "subscription_downgraded",
    "subscription_cancelled",
    "invoice_paid",
    "invoice_failed",
    "trial_started",
    "trial_converted",
]
PLANS = ["starter", "growth", "business", "enterprise"]
PLAN_TIER = {"starter": 1, "growth": 2, "business": 3, "enterprise": 4}
SUBSCRIPTION_STATUSES = ["active", "cancelled", "paused", "trial"]
INVOICE_STATUSES = ["paid", "failed", "pending", "refunded"]
CURRENCY = "INR"
RETENTION_MONTHS = 12
DEFAULT_COHORT_SIZE = 25
KAFKA_TOPIC = "billing-events"
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# End of fixed values.

PAID = "invoice_paid"
FAILED = "invoice_failed"
CREATED = "subscription_created"
CANCELLED = "subscription_cancelled"

EVENTS = StructType(
    [
        StructField("event_id", StringType()),
        StructField("tenant_id", StringType()),
        StructField("event_type", StringType()),
        StructField("plan", StringType()),
        StructField("amount", IntegerType()),
        StructField("currency", StringType()),
        StructField("event_date", TimestampType()),
        StructField("status", StringType()),
        StructField("invoice_id", StringType()),
        StructField("seats", IntegerType()),
        StructField("trial", BooleanType()),
    ]
)

TENANTS = StructType(
    [
        StructField("tenant_id", StringType()),
        StructField("company_name", StringType()),
        StructField("industry", StringType()),
        StructField("plan", StringType()),
        StructField("country", StringType()),
        StructField("signup_date", StringType()),
    ]
)

# One message on the billing topic. The date travels as ISO-8601 text.
MESSAGE = StructType(
    [
        StructField("event_id", StringType()),
        StructField("tenant_id", StringType()),
        StructField("event_type", StringType()),
        StructField("plan", StringType()),
        StructField("amount", IntegerType()),
        StructField("currency", StringType()),
        StructField("event_date", StringType()),
        StructField("status", StringType()),
    ]
)

SCENARIOS = StructType(
    [
        StructField("scenario_id", StringType()),
        StructField("starting_tenants", IntegerType()),
        StructField("monthly_arpu", DoubleType()),
        StructField("monthly_growth_pct", DoubleType()),
        StructField("monthly_churn_pct", DoubleType()),
        StructField("months", IntegerType()),
    ]
)

CHURN = StructType(
    [
        StructField("event_year", IntegerType()),
        StructField("event_month", IntegerType()),
        StructField("period", StringType()),
        StructField("plan", StringType()),
        StructField("active_tenants", LongType()),
        StructField("churned_tenants", LongType()),
        StructField("churn_rate_pct", DoubleType()),
    ]
)

MONTHLY_REVENUE = StructType(
    [
        StructField("tenant_id", StringType()),
        StructField("company_name", StringType()),
        StructField("industry", StringType()),
        StructField("plan", StringType()),
        StructField("country", StringType()),
        StructField("invoice_count", LongType()),
        StructField("total_mrr", LongType()),
        StructField("arr", LongType()),
        StructField("avg_invoice_amount", DoubleType()),
        StructField("billing_month", DateType()),
    ]
)

"""Active and churned tenants, churn reports, billing risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions import (
    failure_reason,
    failure_severity,
    lenient_timestamp,
    lookup,
    pct_label,
    pct_of,
    period,
    plan_label,
)
from recurra.functions.labels import CHURN_PLAN_COLOUR_DEFAULT, CHURN_PLAN_COLOURS
from recurra.schemas import CANCELLED, FAILED, PAID, PLANS

MONTH_PLAN = ["event_year", "event_month", "plan"]


def _tenants_per_plan(events: DataFrame, event_type: str, name: str) -> DataFrame:
    month = period(F.col("event_year"), F.col("event_month")).alias("period")
    return (
        events.filter(F.col("event_type") == event_type)
        .groupBy("event_year", "event_month", month, "plan")
        .agg(F.countDistinct("tenant_id").alias(name))
    )


def active_tenants(events: DataFrame) -> DataFrame:
    """Distinct payers per month and event plan, whatever the payment status."""
    return _tenants_per_plan(events, PAID, "active_tenants")


def churned_tenants(events: DataFrame) -> DataFrame:
    """Distinct cancelling tenants per month and event plan."""
    return _tenants_per_plan(events, CANCELLED, "churned_tenants")


def churn_by_plan(events: DataFrame) -> DataFrame:
    """Churn rate per month and event plan: cancelling over paying tenants.

    The base is the payers of the same month and plan. Months and plans
    without a payer are left out, and a month and plan with payers only has
    zero churn. One pass: events collapse to a row per tenant first (combined
    map-side), then to a row per month and plan.
    """
    per_tenant = (
        events.filter(F.col("event_type").isin(PAID, CANCELLED))
        .groupBy(*MONTH_PLAN, "tenant_id")
        .agg(
            F.max(F.col("event_type") == PAID).alias("paid"),
            F.max(F.col("event_type") == CANCELLED).alias("cancelled"),
        )
    )
    # A NULL plan never equals another NULL plan, hence it has no churn.
    cancelled = F.col("cancelled") & F.col("plan").isNotNull()
    counted = per_tenant.groupBy(*MONTH_PLAN).agg(
        F.count(F.when(F.col("paid"), F.col("tenant_id"))).alias("active_tenants"),
        F.count(F.when(cancelled, F.col("tenant_id"))).alias("churned_tenants"),
    )
    rate = F.round(F.col("churned_tenants") / F.col("active_tenants") * 100, 2)
    return counted.filter(F.col("active_tenants") > 0).select(
        "event_year",
        "event_month",
        period(F.col("event_year"), F.col("event_month")).alias("period"),
        "plan",
        "active_tenants",
        "churned_tenants",
        rate.alias("churn_rate_pct"),
    )


def churn_in_month(churn: DataFrame, month: int = 6) -> DataFrame:
    """Churn rows of one calendar month, over all years."""
    return churn.filter(F.col("event_month") == month)


def churn_by_period(churn: DataFrame) -> DataFrame:
    """Churn per month, summed over plans.

    A tenant that paid under two plans in a month counts twice.
    """
    return churn.groupBy("period").agg(
        F.coalesce(F.sum("active_tenants"), F.lit(0)).alias("active_tenants"),
        F.coalesce(F.sum("churned_tenants"), F.lit(0)).alias("churned_tenants"),
    )


def with_activity(churn: DataFrame) -> DataFrame:
    """Rows with at least one active tenant."""
    return churn.filter(F.col("active_tenants") > 0)


def churn_head(churn: DataFrame, rows: int = 8) -> DataFrame:
    """The first rows with activity, by month and plan."""
    return with_activity(churn).orderBy("event_year", "event_month", "plan").limit(rows)


def latest_churn_period(churn: DataFrame) -> DataFrame:
    """The latest month with churn, or the latest month if none has any."""
    totals = churn_by_period(churn)
    return totals.agg(
        F.coalesce(
            F.max(F.when(F.col("churned_tenants") > 0, F.col("period"))), F.max("period")
        ).alias("selected_period")
    )


def _selected_period_rows(churn: DataFrame) -> DataFrame:
    """One row: the selected period, its totals and its plans as an array.

    Plans are gathered per month from the finished churn table, a handful of
    rows each; the months then compete in one aggregate.
    """
    rate = F.coalesce(F.col("churn_rate_pct"), F.lit(0.0))
    per_period = churn.groupBy("period").agg(
        F.coalesce(F.sum("active_tenants"), F.lit(0)).alias("active"),
        F.coalesce(F.sum("churned_tenants"), F.lit(0)).alias("churned"),
        F.min(F.struct((-rate).alias("order"), F.col("plan"), rate.alias("rate"))).alias("highest"),
        F.min(F.struct(rate.alias("order"), F.col("plan"), rate.alias("rate"))).alias("lowest"),
        *[F.max(F.when(F.col("plan") == plan, rate)).alias(f"rate_{plan}") for plan in PLANS],
    )
    rank = F.struct((F.col("churned") > 0).alias("any"), F.col("period"))
    fields = F.struct(*per_period.columns)
    return per_period.agg(F.max_by(fields, rank).alias("chosen")).select("chosen.*")


def churn_kpis(churn: DataFrame, events: DataFrame) -> DataFrame:
    """One row of churn figures for the selected period, with their labels."""
    cancelled = events.filter(F.col("event_type") == CANCELLED).agg(F.countDistinct("tenant_id"))
    chosen = _selected_period_rows(churn)
    overall = pct_of(F.col("churned"), F.col("active"))
    return chosen.select(
        F.col("period").alias("selected_period"),
        overall.alias("overall_churn_pct"),
        pct_label(overall).alias("overall_churn_label"),
        plan_label(F.col("highest.plan")).alias("highest_plan"),
        F.col("highest.rate").alias("highest_plan_churn"),
        plan_label(F.col("lowest.plan")).alias("lowest_plan"),
        F.col("lowest.rate").alias("lowest_plan_churn"),
        F.col("churned").alias("churned_in_period"),
        cancelled.scalar().alias("all_time_cancelled"),
    ).filter(F.col("selected_period").isNotNull())


def plan_churn(churn: DataFrame) -> DataFrame:
    """Churn of every plan in the selected period; absent plans count as 0."""
    rates = [
        F.struct(F.lit(plan).alias("plan"), F.coalesce(F.col(f"rate_{plan}"), F.lit(0.0)).alias("rate"))
        for plan in PLANS
    ]
    plan, rate = F.col("entry.plan"), F.col("entry.rate")
    return (
        _selected_period_rows(churn)
        .filter(F.col("period").isNotNull())
        .select(F.explode(F.array(*rates)).alias("entry"))
        .select(
            plan_label(plan).alias("plan"),
            rate.alias("churn_rate_pct"),
            pct_label(rate).alias("rate_label"),
            F.floor(F.least(rate * 10, F.lit(100.0))).cast("int").alias("bar_width"),
            lookup(plan, CHURN_PLAN_COLOURS, CHURN_PLAN_COLOUR_DEFAULT).alias("color"),
        )
    )


def billing_risk(
    events: DataFrame, known_tenants: DataFrame, days: int = 90, k: int = 4, latest: Column | None = None
) -> DataFrame:
    """Tenants with the most failed invoices in the last ``days`` days.

    The window ends at the latest event of any type; pass ``latest`` to spare
    the scan for it. The top ``k`` are taken first and unknown tenants dropped
    after, so fewer than ``k`` rows can come out.
    """
    moment = lenient_timestamp(F.col("event_date"), events.schema["event_date"].dataType)
    if latest is None:
        latest = events.agg(F.max(moment)).scalar()
    # Without any date there is no cutoff and every failure counts.
    never = F.lit("0001-01-01").cast("timestamp_ntz")
    cutoff = F.coalesce(latest.cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS"), never)
    failures = (
        events.filter((F.col("event_type") == FAILED) & F.col("tenant_id").isNotNull())
        .filter(F.coalesce(moment.cast("timestamp_ntz"), never) >= cutoff)
        .groupBy("tenant_id")
        .agg(F.count("*").alias("failure_count"))
        .orderBy(F.desc("failure_count"), "tenant_id")
        .limit(k)
    )
    count = F.col("failure_count")
    names = known_tenants.select("tenant_id", "company_name")
    # The unpartitioned window sees at most k rows.
    place = F.row_number().over(Window.orderBy(F.desc("failure_count"), "tenant_id"))
    return names.join(failures, "tenant_id").select(
        place.alias("rank"),
        "tenant_id",
        "company_name",
        "failure_count",
        failure_reason(count).alias("reason"),
        failure_severity(count).alias("color"),
    ).orderBy("rank")


def churn_candidates(
    tenants: DataFrame, invoices: DataFrame, days: int = 60, as_of: Column | None = None
) -> DataFrame:
    """Tenants whose last paid invoice is older than ``days`` days, or who never paid.

    ``as_of`` stands for "today"; by default it is the last billing date known.
    """
    if as_of is None:
        as_of = invoices.agg(F.max("billing_date")).scalar()
    last_paid = (
        invoices.filter(F.col("status") == "paid")
        .groupBy("tenant_id")
        .agg(F.max("billing_date").alias("last_payment"))
    )
    last = F.col("last_payment")
    return (
        tenants.select("tenant_id", "company_name")
        .join(last_paid, "tenant_id", "left")
        .filter(last.isNull() | (last < F.date_sub(as_of, days)))
    )

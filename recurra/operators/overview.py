"""Month-over-month figures, the revenue trend and revenue by plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions import (
    churn_trend,
    count_change_label,
    inr_label,
    lookup,
    pct_label,
    pct_of,
    plan_label,
    trend_class,
    trend_label,
    trend_shade,
)
from recurra.functions.labels import REVENUE_PLAN_COLOUR_DEFAULT, REVENUE_PLAN_COLOURS
from recurra.operators.churn import churn_by_period
from recurra.operators.revenue import latest_tenant_mrr, top_by_ltv
from recurra.schemas import PLAN_TIER

# Trend windows by name and the tallest bar.
TREND_WINDOWS = {"6m": 6, "1y": 12}
TREND_HEIGHT = 90
# End of fixed values.


def _month_index():
    return F.col("event_year") * 12 + F.col("event_month")


def overview_kpis(monthly: DataFrame, churn: DataFrame) -> DataFrame:
    """One row: revenue, payers and churn of the latest month against the one before.

    The "month before" is the previous row; with a single month it is that
    month itself. A month missing from ``churn`` counts as 0 % churn when
    latest, and as nothing to compare with when previous.
    """
    months = monthly.orderBy(F.desc("event_year"), F.desc("event_month")).limit(2)
    pair = months.join(churn_by_period(churn), "period", "left")
    measures = ["period", "total_mrr", "total_arr", "paying_tenants", "active_tenants", "churned_tenants"]
    row = F.struct(*measures)
    figures = pair.agg(
        F.max_by(row, _month_index()).alias("cur"), F.min_by(row, _month_index()).alias("prev")
    ).filter(F.col("cur").isNotNull())

    def change(name):
        return F.col(f"cur.{name}") - F.col(f"prev.{name}")

    churn_pct = pct_of(F.col("cur.churned_tenants"), F.col("cur.active_tenants"))
    prev_churn_pct = F.when(
        F.col("prev.active_tenants").isNotNull(),
        pct_of(F.col("prev.churned_tenants"), F.col("prev.active_tenants")),
    )
    return (
        figures.select(
            F.col("cur.period").alias("period"),
            F.col("cur.total_mrr").alias("total_mrr"),
            pct_of(change("total_mrr"), F.col("prev.total_mrr")).alias("mrr_change_pct"),
            F.col("cur.total_arr").alias("total_arr"),
            pct_of(change("total_arr"), F.col("prev.total_arr")).alias("arr_change_pct"),
            churn_pct.alias("churn_pct"),
            (churn_pct - prev_churn_pct).alias("churn_change"),
            F.col("cur.paying_tenants").alias("paying_tenants"),
            change("paying_tenants").alias("paying_tenants_change"),
        )
    )


def overview_labels(kpis: DataFrame) -> DataFrame:
    """The four report blocks of :func:`overview_kpis`, one row each."""
    churn_text, churn_class = churn_trend(F.col("churn_change"))
    payers_change = F.col("paying_tenants_change")

    def block(label, value, text, css):
        return F.struct(
            F.lit(label).alias("label"),
            value.alias("value"),
            text.alias("trend_text"),
            css.alias("trend_class"),
        )

    blocks = [
        block(
            "Total MRR",
            inr_label(F.col("total_mrr")),
            trend_label(F.col("mrr_change_pct")),
            trend_class(F.col("mrr_change_pct")),
        ),
        block(
            "ARR",
            inr_label(F.col("total_arr")),
            trend_label(F.col("arr_change_pct")),
            trend_class(F.col("arr_change_pct")),
        ),
        block("Churn Rate", pct_label(F.col("churn_pct")), churn_text, churn_class),
        block(
            "Active Tenants",
            F.col("paying_tenants").cast("string"),
            count_change_label(payers_change),
            F.when(payers_change >= 0, F.lit("up")).otherwise(F.lit("dn")),
        ),
    ]
    return kpis.select(F.explode(F.array(*blocks)).alias("block")).select("block.*")


def mrr_trend(monthly: DataFrame, window: str = "1y") -> DataFrame:
    """The latest 6 (``6m``) or 12 (``1y``) months, or all, oldest first, with bar heights.

    The unpartitioned window sees the chosen months only: one row per month.
    """
    shown = monthly
    if window in TREND_WINDOWS:
        shown = monthly.orderBy(F.desc("event_year"), F.desc("event_month")).limit(TREND_WINDOWS[window])
    mrr = F.col("total_mrr")
    tallest = F.max(mrr).over(Window.partitionBy())
    height = F.when(tallest > 0, F.floor(mrr / tallest * TREND_HEIGHT)).otherwise(F.lit(0)).cast("int")
    first_day = F.make_date(F.col("event_year"), F.col("event_month"), F.lit(1))
    return shown.orderBy("event_year", "event_month").select("period", first_day.alias("first_day"), mrr, height.alias("pct_height")).select(
        "period",
        F.date_format("first_day", "MMM").alias("month_name"),
        mrr.alias("mrr"),
        inr_label(mrr).alias("mrr_formatted"),
        "pct_height",
        trend_shade(F.col("pct_height")).alias("color"),
    )


def plan_revenue(mrr: DataFrame, tenants: DataFrame) -> DataFrame:
    """Latest-month revenue, payers and average revenue per *tenant* plan.

    A tenant paid in the globally latest month exactly when its own latest
    month is that month, so one row per tenant is joined with the plans and
    the month is picked afterwards from a few rows per month and plan.
    """
    # Narrow first: history columns that nobody asks for are then never computed.
    narrow = mrr.select("tenant_id", "event_year", "event_month", "period", "mrr")
    latest = narrow.groupBy("tenant_id").agg(F.max(F.struct("event_year", "event_month", "period", "mrr")).alias("last"))
    latest = latest.select("tenant_id", "last.period", "last.mrr")
    per_month = (
        latest.join(tenants.select("tenant_id", "plan"), "tenant_id", "left")
        .groupBy("period", "plan")
        .agg(F.sum("mrr").alias("mrr"), F.count("*").alias("payers"))
    )
    newest = F.max("period").over(Window.partitionBy())
    return (
        per_month.withColumn("newest", newest)
        .filter((F.col("period") == F.col("newest")) & F.col("plan").isNotNull())
        .drop("newest")
    )


def revenue_by_plan(mrr: DataFrame, tenants: DataFrame) -> DataFrame:
    """Latest-month revenue per tenant plan with its truncated share, top tier first."""
    share = F.col("mrr") / F.sum("mrr").over(Window.partitionBy()) * 100
    total = F.sum("mrr").over(Window.partitionBy())
    plan = F.lower("plan")
    return (
        plan_revenue(mrr, tenants)
        .select(
            plan_label(F.col("plan")).alias("plan"),
            F.col("mrr").alias("raw_mrr"),
            inr_label(F.col("mrr")).alias("mrr"),
            F.when(total > 0, F.floor(share)).otherwise(F.lit(0)).cast("int").alias("pct"),
            lookup(plan, REVENUE_PLAN_COLOURS, REVENUE_PLAN_COLOUR_DEFAULT).alias("color"),
            lookup(plan, PLAN_TIER, 0).alias("tier"),
        )
        .orderBy(F.desc("tier"), "plan")
    )


def top_tenants(ltv: DataFrame, mrr: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` tenants of highest lifetime value with their latest month.

    ``mrr`` is the table ``ltv`` was built from, so each tenant has a month.
    """
    best = top_by_ltv(ltv, k).select("tenant_id", "company_name", "plan", "estimated_ltv")
    # The small side cuts the history down before grouping.
    history = mrr.select("tenant_id", "event_year", "event_month", "mrr", "mrr_growth_pct").join(
        best, "tenant_id"
    )
    growth = F.col("mrr_growth_pct")
    place = F.row_number().over(Window.orderBy(F.desc("estimated_ltv"), "tenant_id"))
    # The unpartitioned window sees at most k rows.
    return latest_tenant_mrr(history).select(
        place.alias("rank"),
        "tenant_id",
        "company_name",
        plan_label(F.col("plan")).alias("plan"),
        "estimated_ltv",
        inr_label(F.col("estimated_ltv")).alias("ltv"),
        F.col("mrr").alias("latest_mrr"),
        inr_label(F.col("mrr")).alias("mrr"),
        trend_label(growth).alias("mom_growth"),
        trend_class(growth).alias("mom_class"),
    ).orderBy("rank")

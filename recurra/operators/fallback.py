"""Rows shown when a report has none."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions import inr_label, lookup, plan_label
from recurra.functions.labels import REVENUE_PLAN_COLOUR_DEFAULT, REVENUE_PLAN_COLOURS
from recurra.schemas import PLAN_TIER, PLANS

# Texts of the empty billing-risk report.
NO_RISK_NAME = "No high-risk accounts found"
NO_RISK_REASON = "No recent failed invoices in processed data"
NO_RISK_COLOUR = "var(--color-text-tertiary)"
# End of fixed values.


def _or_else(report: DataFrame, substitute: DataFrame) -> DataFrame:
    """The report, or the substitute if it is empty. Both are a few rows long."""
    spare = F.col("_spare")
    both = report.withColumn("_spare", F.lit(False)).unionByName(substitute.withColumn("_spare", F.lit(True)))
    return (
        both.withColumn("_all_spare", F.min(spare).over(Window.partitionBy()))
        .filter(spare == F.col("_all_spare"))
        .drop("_spare", "_all_spare")
    )


def revenue_by_plan_or_zero(report: DataFrame) -> DataFrame:
    """Revenue by plan, or a zero row for each known plan."""
    plans = report.sparkSession.createDataFrame([(plan,) for plan in PLANS], "name string")
    zero, name = F.lit(0).cast("long"), F.col("name")
    return _or_else(
        report,
        plans.select(
            plan_label(name).alias("plan"),
            zero.alias("raw_mrr"),
            inr_label(zero).alias("mrr"),
            F.lit(0).alias("pct"),
            lookup(name, REVENUE_PLAN_COLOURS, REVENUE_PLAN_COLOUR_DEFAULT).alias("color"),
            lookup(name, PLAN_TIER, 0).alias("tier"),
        ),
    )


def billing_risk_or_notice(report: DataFrame) -> DataFrame:
    """The billing-risk list, or one row saying there is none."""
    notice = report.sparkSession.createDataFrame(
        [(1, None, NO_RISK_NAME, 0, NO_RISK_REASON, NO_RISK_COLOUR)],
        "rank int, tenant_id string, company_name string, failure_count long, reason string, color string",
    )
    return _or_else(report, notice)

"""The tenant list: status, averages, search and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.functions import inr_label, plan_label
from recurra.operators.revenue import tenant_ltv


def latest_period(mrr: DataFrame) -> Column:
    """The latest month of the revenue table, as a scalar."""
    return mrr.agg(F.max("period")).scalar()


def tenant_status(ltv: DataFrame, mrr: DataFrame, latest: Column | None = None) -> DataFrame:
    """Add ``status`` and the latest-month revenue to each tenant.

    Active means a payment in the globally latest month. Each side of the join
    has one row per tenant at most.
    """
    latest = latest_period(mrr) if latest is None else latest
    current = mrr.filter(F.col("period") == latest).select("tenant_id", F.col("mrr").alias("latest_mrr"))
    active = F.col("latest_mrr").isNotNull() | latest.isNull()
    return ltv.join(current, "tenant_id", "left").withColumn(
        "status", F.when(active, "Active").otherwise("Churned")
    )


def tenant_standing(mrr: DataFrame, tenants: DataFrame) -> DataFrame:
    """Lifetime value and status of each known tenant, straight from the revenue table.

    The same rows as :func:`tenant_status` over :func:`~recurra.operators.revenue.tenant_ltv`, for a revenue table
    that isn't stored: it is read once for the tenants and once for its latest month.
    """
    latest = latest_period(mrr)
    last_paid = F.max(F.struct("period", "mrr")).alias("last")
    current = F.col("last.period") == latest
    per_tenant = tenant_ltv(mrr, tenants, last_paid)
    return (
        per_tenant.withColumn("latest_mrr", F.when(current, F.col("last.mrr")))
        .withColumn("status", F.when(current, "Active").otherwise("Churned"))
        .drop("last")
    )


def tenant_portfolio(status: DataFrame) -> DataFrame:
    """One row of counts and averages over all tenants, before any search."""
    return status.agg(
        F.count("*").alias("total_count"),
        F.count(F.when(F.col("status") == "Active", 1)).alias("active_count"),
        F.avg("estimated_ltv").alias("avg_ltv"),
        F.avg("avg_monthly_mrr").alias("arpu"),
    )


def tenant_search(tenants: DataFrame, search: str = "", plan: str = "all", literal: bool = False) -> DataFrame:
    """Tenants whose name or id matches, in one plan or all.

    The search is a case-insensitive regular expression, or plain text with
    ``literal``. A NULL name or id does not match.
    """
    found = tenants
    if search:
        names = [F.col("company_name"), F.col("tenant_id")]
        if literal:
            hits = [F.lower(name).contains(search.lower()) for name in names]
        else:
            hits = [name.rlike(f"(?i){search}") for name in names]
        found = found.filter(F.coalesce(hits[0], F.lit(False)) | F.coalesce(hits[1], F.lit(False)))
    if plan != "all":
        found = found.filter(F.lower("plan") == plan.lower())
    return found


def tenant_page(found: DataFrame, page: int = 1, limit: int = 15) -> DataFrame:
    """One page of tenants by lifetime value, with the count over all pages."""
    shown = F.when(F.col("latest_mrr") > 0, F.col("latest_mrr").cast("double")).otherwise(
        F.col("avg_monthly_mrr")
    )
    return (
        found.orderBy(F.desc("estimated_ltv"), "tenant_id")
        .offset((page - 1) * limit)
        .limit(limit)
        .select(
            "tenant_id",
            "company_name",
            plan_label(F.col("plan")).alias("plan"),
            inr_label(shown).alias("mrr"),
            "active_months",
            inr_label(F.col("estimated_ltv")).alias("ltv"),
            "status",
            found.agg(F.count("*")).scalar().alias("total_filtered"),
        )
    )


"""From raw events to the stored marts, and keeping the revenue view fresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.functions import month_start
from recurra.operators import churn, cohorts, revenue
from recurra.schemas import MONTHLY_REVENUE
from recurra.sources import event_store, files, invoice_store

MARTS = [
    "mrr_by_tenant_month",
    "global_mrr_monthly",
    "tenant_ltv",
    "churn_by_plan_month",
    "cohort_retention",
    "cohort_sizes",
]


def ingest(raw: DataFrame, tenants: DataFrame, root: str) -> None:
    """Write the validated events (one pass for clean and rejected) and the tenants."""
    event_store.write_events(raw, f"{root}/billing_events")
    files.write_table(tenants, f"{root}/tenants")


def build_marts(spark: SparkSession, root: str) -> None:
    """Write the six marts from the tables :func:`ingest` left below ``root``.

    Every step reads tables, so a lost executor costs one step at most, and
    the marts built on others read those instead of computing them again.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}")

    def save(name: str, df: DataFrame) -> None:
        files.write_table(df, f"{root}/{name}")

    events = event_store.read_clean(spark, f"{root}/billing_events")
    save("mrr_by_tenant_month", revenue.monthly_mrr(events))
    save("global_mrr_monthly", revenue.global_mrr(table("mrr_by_tenant_month")))
    save("tenant_ltv", revenue.tenant_ltv(table("mrr_by_tenant_month"), table("tenants")))
    save("churn_by_plan_month", churn.churn_by_plan(events))
    save("cohort_retention", cohorts.cohort_retention(events))
    save("cohort_sizes", cohorts.cohort_sizes(events))


def run_from_csv(spark: SparkSession, events_csv: str, tenants_csv: str, root: str) -> None:
    """CSV exports to stored marts."""
    ingest(files.read_events_csv(spark, events_csv), files.read_tenants_csv(spark, tenants_csv), root)
    build_marts(spark, root)


def write_monthly_revenue(view: DataFrame, path: str, dynamic: bool = False) -> None:
    """Store the revenue view, a directory per billing month."""
    (
        view.select(*MONTHLY_REVENUE.names)
        .hint("rebalance", "billing_month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy("billing_month")
        .parquet(path)
    )


def read_monthly_revenue(spark: SparkSession, path: str) -> DataFrame:
    """The stored revenue view without the markers of emptied months."""
    return spark.read.schema(MONTHLY_REVENUE).parquet(path).filter(F.col("invoice_count") > 0)


def refresh_monthly_revenue(
    invoices: DataFrame, tenants: DataFrame, changed: DataFrame, path: str
) -> None:
    """Recompute the months in which ``changed`` has invoices; leave the others.

    A marker row (no tenant, no invoices) goes into every touched month, so
    that a month that lost its last paid invoice is replaced as well.
    """
    month = month_start(F.col("billing_date"))
    # One row per calendar month.
    touched = changed.select(month.alias("billing_month")).distinct()
    affected = invoices.withColumn("billing_month", month).join(
        F.broadcast(touched), "billing_month", "left_semi"
    )
    _replace_months(affected, tenants, touched, path)


def refresh_from_store(
    spark: SparkSession, invoice_path: str, tenants: DataFrame, touched: DataFrame, path: str
) -> None:
    """Recompute the ``touched`` months from stored invoices, of which no other month is read.

    ``touched`` (billing_month) is what :func:`~recurra.sources.invoice_store.apply_changes` returns. Invoices without
    a date belong to no month that could be refreshed.
    """
    dated = touched.filter(F.col("billing_month") > F.lit(invoice_store.UNDATED).cast("date"))
    affected = invoice_store.in_months(invoice_store.read_invoices(spark, invoice_path), dated)
    _replace_months(affected, tenants, dated, path)


def _replace_months(affected: DataFrame, tenants: DataFrame, touched: DataFrame, path: str) -> None:
    view = revenue.monthly_revenue_view(affected.drop("billing_month"), tenants)
    markers = touched.select("billing_month", F.lit(0).cast("long").alias("invoice_count"))
    write_monthly_revenue(view.unionByName(markers, allowMissingColumns=True), path, dynamic=True)

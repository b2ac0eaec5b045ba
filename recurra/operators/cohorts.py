"""Signup cohorts and their retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import month_distance, period
from recurra.schemas import CANCELLED, CREATED, DEFAULT_COHORT_SIZE, RETENTION_MONTHS


def _lifecycle(events: DataFrame) -> DataFrame:
    """First signup and first cancellation per tenant, in one aggregate."""
    kind, date = F.col("event_type"), F.col("event_date")
    return (
        events.filter(kind.isin(CREATED, CANCELLED) & F.col("tenant_id").isNotNull())
        .groupBy("tenant_id")
        .agg(
            F.min(F.when(kind == CREATED, date)).alias("signup"),
            F.min(F.when(kind == CANCELLED, date)).alias("cancel"),
        )
    )


def cohort_assignment(events: DataFrame) -> DataFrame:
    """Each tenant's cohort: the month of its first ``subscription_created``."""
    first = (
        events.filter((F.col("event_type") == CREATED) & F.col("tenant_id").isNotNull())
        .groupBy("tenant_id")
        .agg(F.min("event_date").alias("first_event_date"))
    )
    year, month = F.year("first_event_date"), F.month("first_event_date")
    return first.select(
        "tenant_id",
        "first_event_date",
        year.alias("cohort_year"),
        month.alias("cohort_month"),
        period(year, month).alias("cohort"),
    )


def first_cancellation(events: DataFrame) -> DataFrame:
    """Month of each tenant's first cancellation; later events do not undo it."""
    first = (
        events.filter((F.col("event_type") == CANCELLED) & F.col("tenant_id").isNotNull())
        .groupBy("tenant_id")
        .agg(F.min("event_date").alias("first_cancel_date"))
    )
    return first.select(
        "tenant_id",
        "first_cancel_date",
        F.year("first_cancel_date").alias("cancel_year"),
        F.month("first_cancel_date").alias("cancel_month"),
    )


def cohort_sizes(events: DataFrame) -> DataFrame:
    """Tenants per cohort."""
    return cohort_assignment(events).groupBy("cohort").agg(F.count("tenant_id").alias("cohort_size"))


def cohort_retention(events: DataFrame) -> DataFrame:
    """Share of each cohort still retained 0 to 11 months after signup.

    A tenant is retained in month 0 always, and later until the month of its
    first cancellation. Tenants collapse to counts per cohort and cancellation
    month before the month offsets multiply them, so the fan-out works on a
    few thousand rows however many tenants there are.
    """
    signup, cancel = F.col("signup"), F.col("cancel")
    year, month = F.year(signup), F.month(signup)
    counts = (
        _lifecycle(events)
        .filter(signup.isNotNull())
        .groupBy(
            period(year, month).alias("cohort"),
            month_distance(year, month, F.year(cancel), F.month(cancel)).alias("cancel_offset"),
        )
        .agg(F.count("*").alias("tenants"))
    )
    offset, left_at = F.col("months_since_start"), F.col("cancel_offset")
    retained = (offset == 0) | left_at.isNull() | (left_at > offset)
    offsets = F.sequence(F.lit(0).cast("long"), F.lit(RETENTION_MONTHS - 1).cast("long"))
    return (
        counts.select("*", F.explode(offsets).alias("months_since_start"))
        .groupBy("cohort", "months_since_start")
        .agg(
            F.sum(F.when(retained, F.col("tenants"))).alias("retained_tenants"),
            F.sum("tenants").alias("cohort_size"),
        )
        .filter(F.col("retained_tenants") > 0)
        .withColumn(
            "retention_pct", F.round(F.col("retained_tenants") / F.col("cohort_size") * 100, 1)
        )
    )


def retention_head(retention: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows of the retention table in cohort order."""
    return retention.orderBy("cohort", "months_since_start").limit(rows)


def cohort_matrix(retention: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per cohort with columns ``M0`` to ``M11``; NULL where none is left."""
    labels = [f"M{offset}" for offset in range(RETENTION_MONTHS)]
    wide = (
        retention.withColumn("slot", F.concat(F.lit("M"), F.col("months_since_start").cast("string")))
        .groupBy("cohort")
        .pivot("slot", labels)
        .agg(F.first("retention_pct"))
    )
    size = F.coalesce(F.col("cohort_size"), F.lit(DEFAULT_COHORT_SIZE).cast("long"))
    return wide.join(sizes.select("cohort", "cohort_size"), "cohort", "left").select(
        "cohort", size.alias("cohort_size"), *labels
    ).orderBy("cohort")


def retention_lists(matrix: DataFrame) -> DataFrame:
    """The matrix with its twelve slots as one array column."""
    slots = [F.col(f"M{offset}") for offset in range(RETENTION_MONTHS)]
    return matrix.select("cohort", "cohort_size", F.array(*slots).alias("retention"))

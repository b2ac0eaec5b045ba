"""Event validation, the reject split and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.schemas import CANCELLED, EVENT_TYPES, PAID


def tag_events(events: DataFrame) -> DataFrame:
    """Add ``validation_error``: the first rule a row breaks, else NULL.

    A NULL type or amount breaks no rule, as a comparison with NULL is not true.
    """
    rules = [
        (F.col("event_id").isNull(), "missing event_id"),
        (F.col("tenant_id").isNull(), "missing tenant_id"),
        (~F.col("event_type").isin(EVENT_TYPES), "invalid event_type"),
        (F.col("amount") < 0, "negative amount"),
        (F.col("event_date").isNull(), "null event_date"),
    ]
    return events.withColumn(
        "validation_error", F.coalesce(*[F.when(broken, F.lit(name)) for broken, name in rules])
    )


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejected)``; together they hold every input row once."""
    tagged = tag_events(events)
    error = F.col("validation_error")
    return tagged.filter(error.isNull()).drop("validation_error"), tagged.filter(error.isNotNull())


def rejection_summary(rejected: DataFrame) -> DataFrame:
    """Rejected rows per broken rule."""
    return rejected.groupBy("validation_error").agg(F.count("*").alias("rejected_rows"))


def enrich_events(clean: DataFrame) -> DataFrame:
    """Add the month columns, the plain date and the two metric flags."""
    return clean.select(
        "*",
        F.year("event_date").alias("event_year"),
        F.month("event_date").alias("event_month"),
        F.to_date("event_date").alias("event_date_only"),
        (F.col("event_type") == PAID).alias("is_revenue_event"),
        (F.col("event_type") == CANCELLED).alias("is_churn_event"),
    )

"""Row counts of the datasets behind the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.functions import grouped_count


def _dataset(df: DataFrame, name: str, count: Column) -> DataFrame:
    return df.agg(count.alias("items")).select(F.lit(name).alias("dataset"), "items")


def dataset_inventory(
    events: DataFrame, rejected: DataFrame, ltv: DataFrame, retention: DataFrame
) -> DataFrame:
    """One row per dataset: item count, its text and whether data has arrived."""
    counts = (
        _dataset(events, "clean_events", F.count("*"))
        .unionByName(_dataset(rejected, "rejected_rows", F.count("*")))
        .unionByName(_dataset(ltv, "paying_tenants", F.count("*")))
        .unionByName(_dataset(retention, "cohorts", F.countDistinct("cohort")))
    )
    filled = F.col("items") > 0
    return counts.select(
        "dataset",
        "items",
        grouped_count(F.col("items")).alias("items_label"),
        F.when(filled, 100).otherwise(0).alias("bar_width"),
        F.when(filled, "st-ok").otherwise("st-idle").alias("status"),
        F.when(filled, "Done").otherwise("Waiting for data").alias("status_text"),
    )

"""The revenue mart with its history, kept up to date by the tenants and months that change.

The table holds the rows of :func:`~recurra.operators.revenue.monthly_mrr`, partitioned by a hash slot of the tenant. An update
takes the months that changed, a row per tenant and month, and rewrites only the slots of their tenants. Within these, a tenant's rows
before its first changed month stay as they are; from that month on they are computed from the running total and the
last two months carried over. So a reader finds previous, running and rolling values ready, and runs no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recurra.operators.revenue import with_history
from recurra.sources.files import load_or_empty

SLOTS = 32
MONTHLY = ["tenant_id", "event_year", "event_month", "mrr", "invoice_count", "avg_seats"]
ROW = (
    "tenant_id STRING, event_year INT, event_month INT, mrr BIGINT, invoice_count BIGINT, avg_seats DOUBLE, period STRING, "
    "prev_mrr BIGINT, mrr_growth_pct DOUBLE, cumulative_mrr BIGINT, rolling_3m_mrr DOUBLE, arr BIGINT"
)
#: Existing months before the first changed one that a rolling value of three months looks back on.
LOOK_BACK = 2


def read(spark: SparkSession, path: str) -> DataFrame:
    """The mart with the columns of the batch table."""
    return load_or_empty(spark, path, StructType.fromDDL(f"{ROW}, slot INT")).drop("slot")


def update(changed: DataFrame, path: str, slots: int = SLOTS) -> None:
    """Puts ``changed`` (the columns ``MONTHLY``, a row per tenant and month) in the place of these months or adds them.

    ``slots`` is part of the stored table and must not change. Their numbers, at most ``slots``, come to the driver.
    Updating with the same rows again changes nothing.
    """
    spark = changed.sparkSession
    slot = F.pmod(F.xxhash64("tenant_id"), F.lit(slots)).cast("int")
    new = changed.select(*MONTHLY, slot.alias("slot")).persist()
    try:
        touched = sorted(row.slot for row in new.select("slot").distinct().collect())
        if not touched:
            return
        old = load_or_empty(spark, path, StructType.fromDDL(f"{ROW}, slot INT")).filter(F.col("slot").isin(touched))
        (
            merged(old.drop("slot"), new.drop("slot"))
            .withColumn("slot", slot)
            .hint("rebalance", "slot")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("slot")
            .parquet(path)
        )
    finally:
        new.unpersist()


def _month() -> Column:
    return F.col("event_year") * 12 + F.col("event_month")


def merged(old: DataFrame, changed: DataFrame) -> DataFrame:
    """The rows of ``old`` after its months have been replaced by, or joined with, those of ``changed``."""
    first = changed.groupBy("tenant_id").agg(F.min(_month()).alias("from_month"))
    known = old.join(first, "tenant_id", "left").withColumn("before", F.col("from_month").isNull() | (_month() < F.col("from_month")))
    kept = known.filter("before").drop("before", "from_month")

    # the last rows before the first changed month, latest first, and the running total up to them
    earlier = known.filter("before AND from_month IS NOT NULL").groupBy("tenant_id").agg(
        F.max_by("cumulative_mrr", _month()).alias("total"),
        F.slice(F.sort_array(F.collect_list(F.struct(_month().alias("at"), *MONTHLY[1:])), asc=False), 1, LOOK_BACK).alias("last"),
    )
    look_back = earlier.select("tenant_id", F.inline("last")).drop("at")
    carried = earlier.select("tenant_id", (F.col("total") - F.aggregate("last", F.lit(0).cast("long"), lambda a, r: a + r["mrr"])).alias("carried"))

    later = known.filter("NOT before").select(*MONTHLY).join(changed, ["tenant_id", "event_year", "event_month"], "left_anti")
    tail = look_back.select(*MONTHLY).unionByName(later.select(*MONTHLY)).unionByName(changed.select(*MONTHLY))
    computed = (
        with_history(tail)
        .join(first, "tenant_id")
        .filter(_month() >= F.col("from_month"))
        .join(carried, "tenant_id", "left")
        .withColumn("cumulative_mrr", F.col("cumulative_mrr") + F.coalesce("carried", F.lit(0)))
    )
    return kept.unionByName(computed.select(*kept.columns))


def of_months(events: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """``events`` of some calendar months; month directories prune."""
    here = F.lit(False)
    for year, month in months:
        here |= (F.col("event_year") == year) & (F.col("event_month") == month)
    return events.filter(here)

"""Invoices stored by billing month, with an index of their ids.

A change names whole invoices. The months to rewrite are those of the new versions and those where the index knows older
ones, so an invoice that moves to another month leaves the old one. Only these months are read and written: they
meet the stored table as a broadcast of one row per month, from which Spark prunes directories at run time.
The index is claimed before the months are written: a write that breaks off is mended by applying the same change again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.functions import month_start
from recurra.sources import id_index

MONTH = "billing_month"
# Where invoices without a date lie.
UNDATED = "0001-01-01"


def _month() -> Column:
    return F.coalesce(month_start(F.col("billing_date")), F.lit(UNDATED).cast("date"))


def _claims(invoices: DataFrame) -> DataFrame:
    at = F.col(MONTH)
    return invoices.select(F.col("invoice_id").alias("event_id"), F.year(at).alias("event_year"), F.month(at).alias("event_month"))


def _ids(path: str) -> str:
    return f"{path.rstrip('/')}-ids"


def _save(invoices: DataFrame, path: str, mode: str) -> None:
    rows = invoices.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", mode)
    rows.partitionBy(MONTH).parquet(path)


def write_invoices(invoices: DataFrame, path: str) -> None:
    """Stores all ``invoices``, a directory per billing month, in the place of what is there, and builds the index of their ids."""
    placed = invoices.withColumn(MONTH, _month())
    _save(placed.withColumn("is_marker", F.lit(False)), path, "static")
    id_index.build(_claims(placed.where("invoice_id IS NOT NULL")), _ids(path))


def read_invoices(spark: SparkSession, path: str) -> DataFrame:
    """The stored invoices with their ``billing_month``, by which a filter or join reads single directories."""
    stored = spark.read.parquet(path)
    return stored.where(~F.col("is_marker")).drop("is_marker").withColumn(MONTH, F.col(MONTH).cast("date"))


def in_months(invoices: DataFrame, months: DataFrame) -> DataFrame:
    """Stored ``invoices`` of ``months`` (billing_month, a row per month): the other directories are not read."""
    # the comparison holds for every month; it tells Spark that the months are worth pruning by
    listed = months.where(F.col(MONTH) >= F.lit(UNDATED).cast("date"))
    return invoices.join(F.broadcast(listed), MONTH, "left_semi")


def touched_months(spark: SparkSession, changed: DataFrame, path: str) -> DataFrame:
    """billing_month: where ``changed`` invoices lie now, or have lain in the stored table."""
    months = changed.select(_month().alias(MONTH))
    index = id_index.open_or_none(spark, _ids(path))
    if index is None:
        raise ValueError(f"no index of invoice ids at {_ids(path)}")
    known = index.located(changed.where("invoice_id IS NOT NULL").select(F.col("invoice_id").alias("event_id")).distinct())
    if known is not None:
        months = months.union(known.select(F.make_date("event_year", "event_month", F.lit(1))))
    return months.distinct()


def apply_changes(spark: SparkSession, changed: DataFrame, path: str) -> DataFrame:
    """Puts ``changed`` invoices in the place of those of the same id, or adds them; returns the months rewritten (billing_month).

    ``changed`` is a table that reads alike each time. Of rows that share an id the largest by all columns counts; ids are not NULL.
    Applying a change again changes nothing. A month that loses its last invoice keeps a marker that readers don't see.
    """
    columns = changed.columns
    latest = changed.groupBy(F.col("invoice_id").alias("key")).agg(F.max(F.struct(*columns)).alias("row")).select("row.*")
    latest = latest.withColumn(MONTH, _month())
    months = touched_months(spark, changed, path)
    index = id_index.open_or_none(spark, _ids(path))
    kept = in_months(read_invoices(spark, path), months).join(latest.select("invoice_id"), "invoice_id", "left_anti")
    index.claim(_claims(latest))
    rows = kept.unionByName(latest).withColumn("is_marker", F.lit(False))
    markers = months.withColumn("is_marker", F.lit(True))
    _save(rows.unionByName(markers, allowMissingColumns=True), path, "dynamic")
    spark.catalog.refreshByPath(path)
    return months

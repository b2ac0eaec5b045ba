"""Streaming jobs: ingest without redelivered copies, running totals, mart refresh, daily counts.

Each job takes a stream of events and starts one query; the caller decides on
the trigger. Sinks are Parquet folders in shared storage. Producers deliver at
least once, so money is summed over event ids: the event store takes each id
once, whatever way the micro-batches are cut, replayed or restarted, and totals
are computed from the store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from recurra.operators.revenue import paid_by_month
from recurra.sources import event_store
from recurra.streaming import history


def start(writer: DataStreamWriter, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start a query; by default it works off what is there and ends."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def ingest(events: DataFrame, path: str) -> DataStreamWriter:
    """Validate, enrich and append to an event store: clean events once by id, conflicts and rejected rows beside them."""

    def append(batch: DataFrame, batch_id: int) -> None:
        event_store.append_once(batch, path)

    return events.writeStream.foreachBatch(append)


def daily_counts(clean: DataFrame, delay: str = "1 day") -> DataFrame:
    """Events per UTC day and type; a day comes out once the watermark has passed it."""
    utc_day = F.date_from_unix_date((F.unix_seconds("day.start") / 86_400).cast("int"))
    return (
        clean.withWatermark("event_date", delay)
        .groupBy(F.window("event_date", "1 day").alias("day"), "event_type")
        .agg(F.count("*").alias("events"))
        .select(utc_day.alias("day"), "event_type", "events")
    )


def running_mrr(spark: SparkSession, path: str) -> DataFrame:
    """Revenue per tenant and month of all events that :func:`ingest` has stored so far."""
    return paid_by_month(event_store.read_clean(spark, path))


def refresh_marts(events: DataFrame, events_path: str, mart_path: str) -> DataStreamWriter:
    """Append each micro-batch to the event store, then bring the revenue mart up to date.

    Of the store, the months of the batch are read, and in them the tenants of the batch: their months are computed from
    stored events, each id once, and merged into the mart (:mod:`~recurra.streaming.history`). Whatever breaks off in between, or
    comes again, the mart ends up the same. Read it with :func:`read_mart`.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            months = event_store.append_once(batch, events_path).months
            if months:
                clean = event_store.stored_layout(batch).filter(F.col("outcome") == event_store.CLEAN)
                stored = history.of_months(event_store.read_clean(batch.sparkSession, events_path), months)
                touched = stored.join(clean.select("tenant_id").distinct(), "tenant_id", "left_semi")
                history.update(paid_by_month(touched), mart_path)
        finally:
            batch.unpersist()

    return events.writeStream.foreachBatch(apply)


def read_mart(spark: SparkSession, mart_path: str) -> DataFrame:
    """The mart of :func:`refresh_marts` with the columns of the batch table, history included and no window to run."""
    return history.read(spark, mart_path)

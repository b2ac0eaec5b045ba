"""Daily counts that lose no late row: what comes after its day was closed is counted and kept beside the rest.

The engine's own watermark drops late rows without a trace. Here each micro-batch is compared with the mark that the batches
before it have set (the latest event seen, less the delay): rows of days that were closed by then are late. A batch writes two folders of
its own number, the counts per day, type and lateness, and the late rows themselves, so a replayed batch
overwrites what it wrote before. A folder belongs to one stream checkpoint.

Counts are combined before they are shuffled; a batch leaves a row per day and type it holds. Only the mark, one number, comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from recurra.sources.files import load_or_empty

DELAY_SECONDS = 86_400
DAY_SECONDS = 86_400
COUNTS = "day DATE, event_type STRING, late BOOLEAN, events BIGINT, newest BIGINT, batch BIGINT"


def _day() -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds("event_date") / DAY_SECONDS).cast("int"))


def _end() -> Column:
    """The first microsecond after the day."""
    return (F.unix_date("day") + 1).cast("long") * F.lit(DAY_SECONDS * 1_000_000)


def _counts(spark: SparkSession, path: str) -> DataFrame:
    return load_or_empty(spark, f"{path}/counts", StructType.fromDDL(COUNTS))


def count_days(clean: DataFrame, path: str, delay_seconds: int = DELAY_SECONDS) -> DataStreamWriter:
    """Counts a stream of clean events into ``path``; read it with :func:`closed_days` and :func:`late_rows`."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = _counts(spark, path).filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        mark = None if newest is None else newest - delay_seconds * 1_000_000
        late = F.lit(False) if mark is None else F.coalesce(_end() <= F.lit(mark), F.lit(False))
        rows = batch.withColumn("day", _day()).withColumn("late", late)
        counted = rows.groupBy("day", "event_type", "late").agg(
            F.count("*").alias("events"), F.max(F.unix_micros("event_date")).alias("newest")
        )
        counted.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/batch={batch_id}")
        if mark is not None:
            rows.filter("late").drop("late").write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")

    return clean.writeStream.foreachBatch(apply)


def closed_days(spark: SparkSession, path: str, delay_seconds: int = DELAY_SECONDS) -> DataFrame:
    """day, event_type, on_time, late and events (their sum) of every day that the latest event has closed."""
    counts = _counts(spark, path)
    mark = counts.agg(F.max("newest") - F.lit(delay_seconds * 1_000_000)).scalar()
    return (
        counts.filter(_end() <= mark)
        .groupBy("day", "event_type")
        .agg(
            F.coalesce(F.sum(F.when(~F.col("late"), F.col("events"))), F.lit(0)).alias("on_time"),
            F.coalesce(F.sum(F.when(F.col("late"), F.col("events"))), F.lit(0)).alias("late"),
            F.sum("events").alias("events"),
        )
    )


def late_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The late rows with their day and batch; ``schema`` is that of the stream's events."""
    layout = StructType.fromDDL("day DATE, batch BIGINT").fields
    return load_or_empty(spark, f"{path}/late", StructType([*schema.fields, *layout]))

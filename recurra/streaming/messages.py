"""Reading, rendering and decoding JSON billing messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from recurra.schemas import KAFKA_TOPIC, MESSAGE

_CORRUPT = "_corrupt_record"


def message_text() -> Column:
    """The JSON text of an event; ``event_date`` must be ISO-8601 text by now."""
    return F.to_json(F.struct(*MESSAGE.names))


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream of JSON lines from a directory."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_message_topic(spark: SparkSession, servers: str, topic: str = KAFKA_TOPIC, **options) -> DataFrame:
    """A stream of JSON texts from a Kafka topic. Needs Spark's Kafka connector."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def decode_messages(messages: DataFrame) -> DataFrame:
    """Billing events from JSON text.

    Fields the message does not carry are NULL. A text that is no valid message
    is kept in ``raw_message``; its missing fields make validation reject it.
    """
    schema = StructType([*MESSAGE.fields, StructField(_CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return messages.select(F.from_json("value", schema, options).alias("m")).select(
        "m.event_id",
        "m.tenant_id",
        "m.event_type",
        "m.plan",
        "m.amount",
        "m.currency",
        F.try_to_timestamp("m.event_date").alias("event_date"),
        "m.status",
        F.lit(None).cast("string").alias("invoice_id"),
        F.lit(None).cast("int").alias("seats"),
        F.lit(None).cast("boolean").alias("trial"),
        F.col(f"m.{_CORRUPT}").alias("raw_message"),
    )

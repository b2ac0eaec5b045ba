"""The stored event table: clean and rejected rows from one pass over the input.

Rows are partitioned by outcome first, then by month, so that one write job
serves the clean table and the dead-letter rows alike, and reports read clean
months only. Rejected rows have no month, as their dates cannot be trusted.
Neither have conflicts: clean events whose id is stored with other content.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recurra.operators.validation import enrich_events, tag_events
from recurra.schemas import EVENTS
from recurra.sources import id_index
from recurra.sources.files import load_or_empty

MONTH = ["event_year", "event_month"]
PARTITIONS = ["outcome", *MONTH]
CLEAN, REJECTED, CONFLICT = "clean", "rejected", "conflict"
CONFLICT_ERROR = "event_id stored with other content"

_DERIVED = ["event_date_only", "is_revenue_event", "is_churn_event"]
# What makes two events of one id the same.
CONTENT = [name for name in EVENTS.names if name != "event_id"]


def stored_layout(raw: DataFrame) -> DataFrame:
    """Raw events as stored: tagged, enriched and with the partition columns."""
    ok = F.col("validation_error").isNull()
    return enrich_events(tag_events(raw)).withColumns(
        {
            "outcome": F.when(ok, CLEAN).otherwise(REJECTED),
            "event_year": F.when(ok, F.col("event_year")),
            "event_month": F.when(ok, F.col("event_month")),
        }
    )


def write_events(raw: DataFrame, path: str) -> None:
    """Validate, enrich and store raw events, replacing what was there.

    ``rebalance`` groups rows by partition before the write, so a task holds
    few of them, while AQE cuts a partition above the advisory size into
    several tasks: neither a file per task and month nor one task for the
    busiest month. An id index beside the store is built anew.
    """
    (
        stored_layout(raw)
        .hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )
    spark = raw.sparkSession
    if id_index.open_or_none(spark, index_path(path)):
        id_index.build(read_clean(spark, path), index_path(path))


@dataclass(frozen=True)
class Appended:
    """What became of a batch: its calendar months, and how many of its rows went where."""

    months: list[tuple[int, int]]
    stored: int
    copies: int
    conflicts: int
    rejected: int


def append_once(events: DataFrame, path: str) -> Appended:
    """Append raw events, the clean ones only if their id isn't stored yet, in whatever month.

    The first stored event of an id stays. Equal rows are copies and leave no trace but a number; a row of the same id with
    other content, be it another amount or another month, goes to the conflicts, each content once. Of several contents
    in one batch the smallest, column by column, is the first. So stored + copies + conflicts + rejected = rows of ``events``,
    and running the same events again, cut in any way, stores nothing twice.

    Known ids are found by the index beside the store (:mod:`~recurra.sources.id_index`), which is built on the first call; of the
    store only the months it names are read, so new ids cost no look at the store at all. Rejected rows may lack an id;
    they are appended as they come.
    """
    spark = events.sparkSession
    batch = stored_layout(events).persist()
    sorted_out = None
    try:
        clean, rejected = (batch.filter(F.col("outcome") == outcome) for outcome in (CLEAN, REJECTED))
        # One row per calendar month in the batch, few of them.
        sizes = batch.groupBy("outcome", *MONTH).count().collect()
        index = id_index.open_or_none(spark, index_path(path))
        index = index or id_index.build(_outcome(spark, path, batch.schema, CLEAN), index_path(path))
        located = index.located(clean.select("event_id").distinct())
        known = None if located is None else _known(spark, path, batch.schema, located)
        sorted_out = _sorted_out(clean, known).persist()
        counts = {
            row.outcome: row for row in sorted_out.groupBy("outcome").agg(F.sum("_rows").alias("rows"), F.count("*").alias("kept")).collect()
        }
        fresh = sorted_out.filter(F.col("outcome") == CLEAN).select(*batch.columns)
        written = fresh.union(rejected)
        if CONFLICT in counts:
            conflicts = sorted_out.filter(F.col("outcome") == CONFLICT).select(*batch.columns)
            written = written.union(_unseen(conflicts, _outcome(spark, path, batch.schema, CONFLICT)))
        if CLEAN in counts:
            index.claim(fresh)
        written.hint("rebalance", *PARTITIONS).write.mode("append").partitionBy(*PARTITIONS).parquet(path)
        n_clean = sum(row["count"] for row in sizes if row.outcome == CLEAN)
        n_stored = counts[CLEAN].kept if CLEAN in counts else 0
        n_conflicts = counts[CONFLICT].rows if CONFLICT in counts else 0
        return Appended(
            months=sorted((row.event_year, row.event_month) for row in sizes if row.outcome == CLEAN),
            stored=n_stored,
            copies=n_clean - n_stored - n_conflicts,
            conflicts=n_conflicts,
            rejected=sum(row["count"] for row in sizes if row.outcome == REJECTED),
        )
    finally:
        batch.unpersist()
        if sorted_out is not None:
            sorted_out.unpersist()


def index_path(path: str) -> str:
    """Where the id index of the store at ``path`` lies."""
    return f"{path.rstrip('/')}-ids"


def _outcome(spark: SparkSession, path: str, schema: StructType, outcome: str) -> DataFrame:
    return load_or_empty(spark, path, schema).filter(F.col("outcome") == outcome)


def _known(spark: SparkSession, path: str, schema: StructType, located: DataFrame) -> DataFrame | None:
    """event_id, content of the stored events among ``located``, read from the months named there only."""
    months = located.select(*MONTH).distinct().collect()
    if not months:
        return None
    here = reduce(or_, ((F.col("event_year") == y) & (F.col("event_month") == m) for y, m in months))
    stored = _outcome(spark, path, schema, CLEAN).filter(here)
    return stored.join(located.select("event_id").distinct(), "event_id", "left_semi").select("event_id", F.struct(*CONTENT).alias("content"))


def _unseen(conflicts: DataFrame, seen: DataFrame) -> DataFrame:
    """``conflicts`` as they are stored, but for those that are."""
    new, old = conflicts.alias("new"), seen.select("event_id", *CONTENT).alias("old")
    same = (F.col(f"new.{name}").eqNullSafe(F.col(f"old.{name}")) for name in CONTENT)
    rows = new.join(old, reduce(and_, same, F.col("new.event_id") == F.col("old.event_id")), "left_anti")
    return rows.withColumns({"validation_error": F.lit(CONFLICT_ERROR), **{name: F.lit(None).cast("int") for name in MONTH}})


def _sorted_out(clean: DataFrame, known: DataFrame | None) -> DataFrame:
    """A row per id and content of ``clean``, with ``_rows``, how many there are, and its outcome: clean, conflict, null for copies.

    Rows are counted before they are shuffled, so an id delivered very often is one row a task.
    """
    rest = F.struct(*(name for name in clean.columns if name not in ("event_id", "outcome", *CONTENT)))
    contents = clean.groupBy("event_id", F.struct(*CONTENT).alias("content")).agg(F.count("*").alias("_rows"), F.min(rest).alias("rest"))
    joined = contents.withColumn("first", F.min("content").over(Window.partitionBy("event_id")))
    if known is None:
        joined = joined.withColumn("stored", F.lit(None).cast("array<string>"))
        copy = F.lit(False)
    else:
        joined = joined.join(known.groupBy("event_id").agg(F.collect_set("content").alias("stored")), "event_id", "left")
        copy = F.coalesce(F.array_contains("stored", F.col("content")), F.lit(False))
    fresh = F.col("stored").isNull() & (F.col("content") == F.col("first"))
    outcome = F.when(fresh, CLEAN).when(~copy, CONFLICT)
    return joined.select("event_id", "content.*", "rest.*", "_rows", outcome.alias("outcome"))


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Clean enriched events; month filters prune directories."""
    stored = spark.read.parquet(path)
    return stored.filter(F.col("outcome") == CLEAN).drop("outcome", "validation_error", "raw_message")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Rejected events with the rule they broke."""
    stored = spark.read.parquet(path)
    return stored.filter(F.col("outcome") == REJECTED).drop(*PARTITIONS, *_DERIVED)


def read_conflicts(spark: SparkSession, path: str) -> DataFrame:
    """Clean events that weren't stored, as their id is stored with other content."""
    stored = spark.read.parquet(path)
    return stored.filter(F.col("outcome") == CONFLICT).drop(*PARTITIONS, *_DERIVED)

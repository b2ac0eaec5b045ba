"""Where event ids are stored: an index in hash buckets, with a Bloom filter in front of each bucket.

Below ``path`` lie two tables.

- ``ids``, a directory per bucket: every claimed event id with the month its event goes to.
- ``bloom``: a bitmap of 32 768 bits per bucket and block. An id sets ``HASHES`` bits of one block. Appends add bitmaps for
  the blocks they touch, readers OR them together.

An id is claimed before its event is stored, so that the index knows every stored event whatever breaks off in between; a claim whose
event was never stored does no harm, as the event store itself is looked at in the end. A batch of new ids reads the
filters, about 1.2 bytes per stored id at one percent of false hits, and hardly any bucket. Everything is built-in columns.

A block holds about 3 400 ids at one percent. :func:`fill` tells how full the blocks are; beyond that the filters
say yes more often, which costs reads but never a wrong answer. :func:`build` writes an index anew, with more blocks if wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recurra.sources.files import load_or_empty

BUCKETS = 32
BLOCKS = 8
HASHES = 7
BITS = 32_768
MONTH = ["event_year", "event_month"]

_LAYOUT = "buckets INT, blocks INT"
_BLOOM = "bucket INT, block INT, bits BINARY"
_IDS = "event_id STRING, event_year INT, event_month INT, bucket INT"


class Index:
    """An index opened for reading and claiming. Its numbers of buckets and blocks are part of what is stored."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, blocks: int):
        self.spark, self.path, self.buckets, self.blocks = spark, path, buckets, blocks

    def _placed(self, ids: DataFrame) -> DataFrame:
        """``ids`` with bucket, block and the positions of their bits."""
        step = F.xxhash64("event_id", F.lit(2)).bitwiseOR(F.lit(1))
        first = F.xxhash64("event_id", F.lit(1))
        # wrapped to 15 bits before they are added up, so that nothing overflows
        spots = [F.pmod(F.pmod(first, F.lit(BITS)) + k * F.pmod(step, F.lit(BITS)), F.lit(BITS)) for k in range(HASHES)]
        return ids.withColumns(
            {
                "bucket": F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int"),
                "block": F.pmod(F.xxhash64("event_id", F.lit(3)), F.lit(self.blocks)).cast("int"),
                "spots": F.array(*spots),
            }
        )

    def _table(self, name: str, ddl: str) -> DataFrame:
        return load_or_empty(self.spark, f"{self.path}/{name}", StructType.fromDDL(ddl))

    def filters(self) -> DataFrame:
        """bucket, block, bits: the Bloom filters, a row per block with any id."""
        return self._table("bloom", _BLOOM).groupBy("bucket", "block").agg(F.bitmap_or_agg("bits").alias("bits"))

    def maybe(self, ids: DataFrame) -> DataFrame:
        """event_id, bucket: those of ``ids`` (distinct) that may be in the index, and hardly any other."""
        hits = F.forall("spots", lambda spot: _bit("bits", spot))
        return self._placed(ids).join(self.filters(), ["bucket", "block"]).filter(hits).select("event_id", "bucket")

    def located(self, ids: DataFrame) -> DataFrame | None:
        """event_id, event_year, event_month: the months in which those of ``ids`` (distinct) that are known have been claimed.

        None if the filters know that all ids are new. Only buckets for which a filter says yes are read; their numbers,
        at most ``buckets``, come to the driver.
        """
        candidates = self.maybe(ids)
        probed = sorted(row.bucket for row in candidates.select("bucket").distinct().collect())
        if not probed:
            return None
        stored = self._table("ids", _IDS).filter(F.col("bucket").isin(probed))
        return stored.join(candidates.select("event_id"), "event_id", "left_semi").select("event_id", *MONTH).distinct()

    def claim(self, events: DataFrame, mode: str = "append") -> None:
        """Adds event_id and month of ``events``. Claiming again changes no answer."""
        placed = self._placed(events.select("event_id", *MONTH).distinct())
        rows = placed.select("event_id", *MONTH, "bucket").hint("rebalance", "bucket")
        rows.write.mode(mode).partitionBy("bucket").parquet(f"{self.path}/ids")
        bits = placed.select("bucket", "block", F.explode("spots").alias("spot"))
        bitmaps = bits.groupBy("bucket", "block").agg(F.bitmap_construct_agg("spot").alias("bits"))
        bitmaps.write.mode(mode).parquet(f"{self.path}/bloom")

    def fill(self) -> DataFrame:
        """bucket, block, filled (share of bits set), false_hits (expected share of new ids that the filter lets through)."""
        filled = F.bitmap_count("bits") / BITS
        return self.filters().select("bucket", "block", filled.alias("filled"), F.pow(filled, F.lit(HASHES)).alias("false_hits"))


def _bit(bits: str, spot: Column) -> Column:
    """Whether bit ``spot`` is set: bytes from the left, bits of a byte from the lowest."""
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(spot / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (spot % 8).cast("int")) == 1


def build(events: DataFrame, path: str, buckets: int = BUCKETS, blocks: int = BLOCKS) -> Index:
    """A new index at ``path`` of all ``events`` (event_id, event_year, event_month), in the place of what is there."""
    spark = events.sparkSession
    index = Index(spark, path, buckets, blocks)
    index.claim(events, "overwrite")
    # the layout comes last: an index without one was broken off and is built again
    spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(blocks).alias("blocks")).write.mode("overwrite").parquet(f"{path}/layout")
    return index


def open_or_none(spark: SparkSession, path: str) -> Index | None:
    """The index at ``path``, or none where there isn't a whole one."""
    row = load_or_empty(spark, f"{path}/layout", StructType.fromDDL(_LAYOUT)).first()
    return Index(spark, path, row.buckets, row.blocks) if row else None

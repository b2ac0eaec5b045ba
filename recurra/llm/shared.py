"""Cutting lineage in the shared folder, schemas, and connected components of a link table."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def checkpoint(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once below ``spark.checkpoint.dir`` and read back from there.

    Only a session without that setting (tests on one machine) gets a temporary folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="recurra-checkpoints-"))
    return df.checkpoint()


def widened(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` with further columns."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


def sampled(texts: DataFrame, rows: int, size: int) -> DataFrame:
    """The first ``rows`` of ``texts`` by ``order``, ended by the one that brings the sum of ``n_bytes`` to ``size`` or more.

    Whether a text is in doesn't depend on its own length; only the limited rows meet in one task.
    """
    some = texts.orderBy("order").limit(rows)
    before = F.coalesce(F.sum("n_bytes").over(Window.orderBy("order").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return some.withColumn("_before", before).where(F.col("_before") < size).drop("_before")


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected links ``a``, ``b``, by alternating large and small stars.

    Returns ``node``, ``component``: a row for each node that isn't the smallest of its component.
    Every round is a minimum per node (combined before the shuffle) and a join back; the links only
    ever shrink towards stars, and their number of rounds is logarithmic in the size of a component.
    Null or equal ends are no links. Nothing is collected but a count and a checksum per round.
    """
    stars = checkpoint(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = None
    while True:
        mark = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark[0] == 0 or mark == seen:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = mark
        stars = checkpoint(_small_star(_large_star(stars)))


def _large_star(stars: DataFrame) -> DataFrame:
    """Ties each larger neighbour of a node to the smallest of the node's neighbourhood."""
    both = stars.union(stars.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(stars: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    least = stars.groupBy("u").agg(F.min("v").alias("m"))
    moved = stars.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.toDF("u", "v")).distinct()

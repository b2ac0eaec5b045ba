"""Exact-size seeded sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKET_DIGITS = 4


def sample_rows(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement (all rows if there are fewer).

    Each row draws a number, the MD5 of the seed and its columns as text, and the ``n`` smallest draws win, so
    the same table and seed always give the same sample. A histogram of the draws by their first
    hex digits (65 536 buckets at most) tells in which bucket the sample ends. A second pass keeps the buckets up to it, with
    equal rows collapsed to one row and a count, and ranks within buckets; the last one gives as many as are missing.
    """
    columns = df.columns
    text = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in columns]
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *text))
    drawn = df.withColumn("_draw", draw).withColumn("_bucket", F.substring("_draw", 1, _BUCKET_DIGITS))
    in_order = Window.orderBy("_bucket")
    histogram = drawn.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    running = histogram.select("_bucket", "_rows", F.sum("_rows").over(in_order).alias("_running"))
    ends = running.filter((F.col("_running") >= n) & (F.col("_running") - F.col("_rows") < n))
    end = ends.agg(F.max(F.struct(F.col("_bucket").alias("last"), (F.col("_running") - F.col("_rows")).alias("before")))).scalar()

    below = F.coalesce(F.col("_bucket") <= end["last"], F.lit(n > 0))
    given = [F.col(f"`{c}`") for c in columns]
    distinct = drawn.filter(below).groupBy(*given, "_draw", "_bucket").agg(F.count("*").alias("_copies"))
    ranked = Window.partitionBy("_bucket").orderBy("_draw", *given).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    room = n - end["before"] - F.sum("_copies").over(ranked) + F.col("_copies")
    whole = F.coalesce(F.col("_bucket") < end["last"], F.lit(True))
    taken = F.when(whole, F.col("_copies")).otherwise(F.least(F.col("_copies"), room))
    kept = distinct.withColumn("_taken", taken.cast("int")).filter(F.col("_taken") > 0)
    return kept.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_taken")))).select(*given)

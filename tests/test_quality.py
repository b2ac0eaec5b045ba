import hashlib

from pyspark.sql import functions as F

from recurra.operators import quality
from recurra.operators.sampling import sample_rows
from tests.rows import collected


def test_checks(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("b", None), (None, "z"), (None, "z")]
    df = spark.createDataFrame(rows, "k string, v string")
    dup = quality.duplicate_keys(df, "t", ["k"]).first()
    assert (dup.duplicate_keys, dup.surplus_rows) == (1, 2)
    pair = quality.duplicate_keys(df, "t", ["k", "v"]).first()
    assert (pair.key_columns, pair.duplicate_keys, pair.surplus_rows) == ("k,v", 1, 1)
    assert [(r["column_name"], r["null_rows"]) for r in collected(quality.null_counts(df, "t", ["k", "v"]), "column_name")] == [("k", 2), ("v", 1)]
    assert quality.domain_violations(df, "t", {"v": ["x", "y"]}).first().violations == 2
    parents = spark.createDataFrame([("b",)], "id string")
    assert [tuple(r) for r in quality.orphans(df, "k", parents, "id").collect()] == [("a", 3)]
    clean = quality.duplicate_keys(df.limit(0), "t", ["k"]).first()
    assert (clean.duplicate_keys, clean.surplus_rows) == (0, 0)


def test_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None, None), (5, "USD", "failed", True, 2)], "amount int, currency string, status string, trial boolean, seats int")
    assert [tuple(r) for r in quality.with_defaults(df).collect()] == [(0, "INR", "success", False, None), (5, "USD", "failed", True, 2)]

    seats = quality.with_defaults(df, quality.SUBSCRIPTION_DEFAULTS).collect()
    assert [(r.amount, r.seats) for r in seats] == [(None, 1), (5, 2)]


def test_sample_is_exact_repeatable_and_the_smallest_draws(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 7).alias("v")).repartition(5)
    for n in (1, 777, 19_999):
        draws = sorted((hashlib.md5(f"3|{r.id}|{r.v}".encode()).hexdigest(), r.id) for r in df.collect())
        want = draws[:n]
        got = [r.id for r in sample_rows(df, n, seed=3).collect()]
        assert sorted(got) == sorted(i for _, i in want)
    assert sample_rows(df, 50_000).count() == 20_000
    assert sample_rows(df, 100, 1).exceptAll(sample_rows(df, 100, 2)).count() > 0
    copies = spark.createDataFrame([("same",)] * 500 + [("other",)], "v string")
    for n in (0, 1, 400, 500, 501, 900):
        assert sample_rows(copies, n).count() == min(n, 501)


def test_sample_sorts_one_bucket_only(spark):
    """A large sample neither sorts its rows nor gathers them in one task; odd column names and NULLs are kept."""
    df = spark.range(50_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("a.b"), F.lit(None).cast("string").alias("_x"))
    sample = sample_rows(df, 20_000)
    text = sample._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in text and "Limit" not in text
    assert sample.columns == ["a.b", "_x"] and sample.count() == 20_000
    assert sample.exceptAll(df).count() == 0

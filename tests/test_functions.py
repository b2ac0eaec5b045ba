import math
import random

import pytest
from pyspark.sql import functions as F

from recurra import functions as fn


def python_inr(v):
    if v is None or math.isnan(v):
        return "INR 0"
    for size, unit, digits in [(10_000_000, "Cr", 2), (100_000, "L", 2), (1_000, "k", 1)]:
        if v >= size:
            return f"INR {v / size:.{digits}f}{unit}"
    return f"INR {v:.0f}"


def python_trend(p):
    if p is None or math.isnan(p):
        return "-", "neutral"
    if p > 0:
        return f"+{p:.1f}%", "up"
    return (f"-{abs(p):.1f}%", "dn") if p < 0 else ("0.0%", "neutral")


@pytest.fixture(scope="module")
def numbers():
    rng = random.Random(7)
    ties = [k / 20 for k in range(400)] + [k / 200 for k in range(400)] + [k * 50_000.0 for k in range(400)]
    spread = [rng.uniform(-2e3, 2e3) for _ in range(500)] + [10 ** rng.uniform(0, 9) for _ in range(500)]
    edges = [0.0, 999.5, 999.95, 1000.0, 99_999.99, 100_000.0, 9_999_999.0, 1e7, -5e8, -0.4, float("nan"), None]
    return ties + [-t for t in ties[:100]] + spread + edges


def test_half_even_rounding_matches_python(spark, numbers):
    values = [n for n in numbers if n is not None and not math.isnan(n)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2):
        got = df.select("x", fn.round_half_even(F.col("x"), digits).alias("y")).collect()
        assert [(r.x, r.y) for r in got if r.y != round(r.x, digits)] == []


def test_labels_match_python_formatting(spark, numbers):
    x = F.col("x")
    df = spark.createDataFrame([(v,) for v in numbers], "x double")
    for r in df.select("x", fn.inr_label(x), fn.trend_label(x), fn.trend_class(x)).collect():
        assert r[1] == python_inr(r.x)
        assert (r[2], r[3]) == python_trend(r.x)


def test_churn_trend_calls_a_rise_bad(spark):
    text, css = fn.churn_trend(F.col("x"))
    df = spark.createDataFrame([(1.25,), (-0.75,), (0.0,), (None,)], "x double")
    assert [tuple(r) for r in df.select(text, css).collect()] == [
        ("+1.2% vs last mo", "dn"),
        ("-0.8% vs last mo", "up"),
        ("No change", "neutral"),
        ("-", "neutral"),
    ]


def test_small_labels(spark):
    df = spark.createDataFrame([(3, "growth"), (-2, "odd"), (0, None)], "n long, plan string")
    got = df.select(
        fn.count_change_label(F.col("n")),
        fn.failure_reason(F.col("n")),
        fn.failure_severity(F.col("n")),
        fn.plan_label(F.col("plan")),
        fn.lookup(F.col("plan"), {"growth": "#1"}, "#0"),
        fn.grouped_count(F.col("n") * 1_000_000),
    ).collect()
    assert tuple(got[0]) == (
        "+3 this month",
        "3 failed invoices in last 90d",
        "var(--color-text-danger)",
        "Growth",
        "#1",
        "3,000,000",
    )
    assert got[1][0] == "-2 this month" and got[1][4] == "#0"
    assert got[2][0] == "+0 this month" and got[2][4] == "#0"


def test_shades_change_above_their_bound(spark):
    df = spark.createDataFrame([(h,) for h in (90, 76, 75, 51, 50, 31, 30, 16, 15, 0)], "h int")
    got = [r[0] for r in df.select(fn.trend_shade(F.col("h"))).collect()]
    assert got == [
        "#0C447C", "#0C447C", "#185FA5", "#185FA5", "#378ADD", "#378ADD", "#85B7EB", "#85B7EB", "#B5D4F4", "#B5D4F4",
    ]


def test_months(spark):
    row = spark.range(1).select(
        fn.period(F.lit(2024), F.lit(3)),
        fn.month_distance(F.lit(2023), F.lit(11), F.lit(2024), F.lit(2)),
        fn.month_start(F.lit("2024-02-29").cast("date")).cast("string"),
    ).first()
    assert tuple(row) == ("2024-03", 3, "2024-02-01")


def test_long_keys_stay_distinct(spark):
    df = spark.createDataFrame([(7,), (12345678901,), (12345678902,)], "k long")
    got = [r[0] for r in df.select(F.expr(fn.padded_id("TNT_", "k"))).collect()]
    assert got == ["TNT_0000000007", "TNT_12345678901", "TNT_12345678902"]

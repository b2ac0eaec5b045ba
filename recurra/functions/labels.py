"""Display labels used by the revenue and churn reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recurra.functions.numeric import fixed_text

# Label thresholds, units, colours and texts of the reports.
INR_UNITS = [(10_000_000, "Cr", 2), (100_000, "L", 2), (1_000, "k", 1)]
TREND_SHADES = [(75, "#0C447C"), (50, "#185FA5"), (30, "#378ADD"), (15, "#85B7EB")]
TREND_SHADE_LOWEST = "#B5D4F4"
REVENUE_PLAN_COLOURS = {
    "enterprise": "#3C3489",
    "business": "#185FA5",
    "growth": "#0F6E56",
    "starter": "#633806",
}
REVENUE_PLAN_COLOUR_DEFAULT = "#185FA5"
CHURN_PLAN_COLOURS = {
    "starter": "#E24B4A",
    "growth": "#EF9F27",
    "business": "#85B7EB",
    "enterprise": "#1D9E75",
}
CHURN_PLAN_COLOUR_DEFAULT = "#85B7EB"
SEVERE_FAILURES = 3
SEVERITY_DANGER = "var(--color-text-danger)"
SEVERITY_WARNING = "var(--color-text-warning)"
# End of fixed values.


def inr_label(value: Column) -> Column:
    """Compact rupee text: crore, lakh, thousand or whole rupees.

    NULL and NaN give ``INR 0``; negative values are never scaled.
    """
    v = value.cast("double")
    label = F.when(v.isNull() | F.isnan(v), F.lit("INR 0"))
    for size, unit, digits in INR_UNITS:
        scaled = fixed_text(v / float(size), digits)
        label = label.when(v >= size, F.concat(F.lit("INR "), scaled, F.lit(unit)))
    return label.otherwise(F.concat(F.lit("INR "), fixed_text(v, 0)))


def pct_label(value: Column) -> Column:
    """Percentage with one decimal."""
    return F.concat(fixed_text(value, 1), F.lit("%"))


def trend_label(pct: Column) -> Column:
    """Signed percentage text; ``-`` when there is nothing to compare with."""
    v = pct.cast("double")
    return (
        F.when(v.isNull() | F.isnan(v), F.lit("-"))
        .when(v > 0, F.concat(F.lit("+"), pct_label(v)))
        .when(v < 0, F.concat(F.lit("-"), pct_label(F.abs(v))))
        .otherwise(F.lit("0.0%"))
    )


def trend_class(change: Column) -> Column:
    """``up``, ``dn`` or ``neutral`` by the sign of ``change``."""
    v = change.cast("double")
    return (
        F.when(v.isNull() | F.isnan(v), F.lit("neutral"))
        .when(v > 0, F.lit("up"))
        .when(v < 0, F.lit("dn"))
        .otherwise(F.lit("neutral"))
    )


def churn_trend(change: Column) -> tuple[Column, Column]:
    """Text and class of a churn change; rising churn is the bad direction."""
    versus = F.concat(trend_label(change), F.lit(" vs last mo"))
    text = (
        F.when(change.isNull(), F.lit("-")).when(change == 0, F.lit("No change")).otherwise(versus)
    )
    return text, trend_class(-change)


def count_change_label(change: Column) -> Column:
    """``+n this month`` or ``-n this month``."""
    sign = F.when(change >= 0, F.lit("+")).otherwise(F.lit("-"))
    return F.concat(sign, F.abs(change).cast("string"), F.lit(" this month"))


def trend_shade(height: Column) -> Column:
    """One of five shades, darker for taller bars."""
    shades = [F.when(height > above, F.lit(colour)) for above, colour in TREND_SHADES]
    return F.coalesce(*shades, F.lit(TREND_SHADE_LOWEST))


def plan_label(plan: Column) -> Column:
    """Plan name with a capital first letter."""
    return F.initcap(plan)


def lookup(key: Column, values: dict, default) -> Column:
    """Value of a small literal map, ``default`` for unknown keys."""
    entries = [F.lit(part) for entry in values.items() for part in entry]
    return F.coalesce(F.create_map(*entries)[key], F.lit(default))


def failure_reason(failures: Column) -> Column:
    """Plain-text reason for a billing-risk row."""
    return (
        F.when(failures > 1, F.concat(failures.cast("string"), F.lit(" failed invoices in last 90d")))
        .otherwise(F.lit("1 failed invoice in last 90d"))
    )


def failure_severity(failures: Column) -> Column:
    """Severity colour of a billing-risk row."""
    return (
        F.when(failures >= SEVERE_FAILURES, F.lit(SEVERITY_DANGER)).otherwise(F.lit(SEVERITY_WARNING))
    )


def grouped_count(count: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(count, 0)

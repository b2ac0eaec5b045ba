"""Column functions: pure Catalyst expressions, no Python per row."""

from recurra.functions.calendar import lenient_timestamp, month_distance, month_start, period
from recurra.functions.labels import (
    churn_trend,
    count_change_label,
    failure_reason,
    failure_severity,
    grouped_count,
    inr_label,
    lookup,
    pct_label,
    plan_label,
    trend_class,
    trend_label,
    trend_shade,
)
from recurra.functions.numeric import fixed_text, pct_of, round_half_even
from recurra.functions.text import padded_id

__all__ = [
    "churn_trend",
    "count_change_label",
    "failure_reason",
    "fixed_text",
    "failure_severity",
    "grouped_count",
    "inr_label",
    "lenient_timestamp",
    "lookup",
    "month_distance",
    "month_start",
    "padded_id",
    "pct_label",
    "pct_of",
    "period",
    "plan_label",
    "round_half_even",
    "trend_class",
    "trend_label",
    "trend_shade",
]

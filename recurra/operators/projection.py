"""What-if revenue projections over a table of scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import inr_label, round_half_even
from recurra.operators.overview import plan_revenue
from recurra.schemas import SCENARIOS

# Accepted input ranges, checked in this order.
SCENARIO_RANGES = {
    "starting_tenants": (1, 100_000),
    "monthly_arpu": (0, 10_000_000),
    "monthly_growth_pct": (-100, 200),
    "monthly_churn_pct": (0, 100),
    "months": (1, 36),
}
# End of fixed values.


def split_scenarios(scenarios: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; rejects name the first input out of its range."""
    checks = []
    for name, (low, high) in SCENARIO_RANGES.items():
        value = F.col(name)
        inside = F.coalesce(value.between(low, high) & ~F.isnan(value.cast("double")), F.lit(False))
        checks.append(F.when(~inside, F.lit(f"{name} out of range")))
    tagged = scenarios.withColumn("scenario_error", F.coalesce(*checks))
    error = F.col("scenario_error")
    return tagged.filter(error.isNull()).drop("scenario_error"), tagged.filter(error.isNotNull())


def _with_path(scenarios: DataFrame) -> DataFrame:
    """Add ``path``: the tenants at the end of months 0, 1, ... as an array.

    Months are folded one after the other inside the row: a power would round
    differently. A path has 37 numbers at most.
    """
    growth, churn = F.col("growth"), F.col("churn")

    def step(path, month):
        start = F.element_at(path, -1)
        added = F.greatest(start * growth, -start)
        return F.concat(path, F.array(F.greatest(start + added - start * churn, F.lit(0.0))))

    begin = F.array(F.col("starting_tenants").cast("double"))
    months = F.sequence(F.lit(1), F.col("months"))
    rates = scenarios.withColumns(
        {"growth": F.col("monthly_growth_pct") / 100, "churn": F.col("monthly_churn_pct") / 100}
    )
    return rates.withColumn("path", F.aggregate(months, begin, step))


def revenue_projection(scenarios: DataFrame) -> DataFrame:
    """One row per scenario and month. Scenarios stay in their partitions."""
    start, end = F.col("start"), F.col("end")
    figures = (
        _with_path(scenarios)
        .select("*", F.explode(F.sequence(F.lit(1), F.col("months"))).alias("month"))
        .select(
            "scenario_id",
            "month",
            "growth",
            "churn",
            "monthly_arpu",
            F.element_at("path", F.col("month")).alias("start"),
            F.element_at("path", F.col("month") + 1).alias("end"),
        )
        .select(
            "scenario_id",
            "month",
            "start",
            "end",
            F.greatest(start * F.col("growth"), -start).alias("added"),
            (start * F.col("churn")).alias("churned"),
            (end * F.col("monthly_arpu")).alias("mrr"),
        )
    )
    mrr = F.col("mrr")
    return figures.select(
        "scenario_id",
        "month",
        round_half_even(start, 1).alias("starting_tenants"),
        round_half_even(F.col("added"), 1).alias("added_tenants"),
        round_half_even(F.col("churned"), 1).alias("churned_tenants"),
        round_half_even(end, 1).alias("ending_tenants"),
        round_half_even(mrr, 2).alias("mrr"),
        inr_label(mrr).alias("mrr_formatted"),
        inr_label(mrr * 12).alias("arr_formatted"),
    )


def projection_summary(scenarios: DataFrame) -> DataFrame:
    """One row per scenario: start against end. Ends are the rounded monthly values."""
    starting, ending, tenants = F.col("start_value"), F.col("end_value"), F.col("tenants")
    figures = (
        _with_path(scenarios)
        .withColumn("tenants", F.element_at("path", -1))
        .select(
            "scenario_id",
            (F.col("starting_tenants").cast("double") * F.col("monthly_arpu")).alias("start_value"),
            (tenants * F.col("monthly_arpu")).alias("end_value"),
            "tenants",
        )
        .withColumn("end_value", round_half_even(ending, 2))
        .withColumn("change", ending - starting)
        .withColumn("change_pct", F.when(starting != 0, F.col("change") / starting * 100).otherwise(F.lit(0.0)))
    )
    return figures.select(
        "scenario_id",
        inr_label(starting).alias("starting_mrr"),
        inr_label(ending).alias("ending_mrr"),
        inr_label(ending * 12).alias("ending_arr"),
        inr_label(F.col("change")).alias("mrr_change"),
        round_half_even(F.col("change_pct"), 1).alias("mrr_change_pct"),
        round_half_even(tenants, 1).alias("ending_tenants"),
    )


def plan_scenarios(
    mrr: DataFrame, tenants: DataFrame, plan_churn: DataFrame, growth_pct: float = 4.0, months: int = 12
) -> DataFrame:
    """A scenario per plan from its latest payers, average revenue and churn."""
    observed = plan_revenue(mrr, tenants).select(
        F.initcap("plan").alias("plan"),
        F.col("payers").cast("int").alias("starting_tenants"),
        (F.col("mrr") / F.col("payers")).alias("monthly_arpu"),
    )
    return observed.join(plan_churn.select("plan", "churn_rate_pct"), "plan").select(
        F.col("plan").alias("scenario_id"),
        "starting_tenants",
        "monthly_arpu",
        F.lit(float(growth_pct)).alias("monthly_growth_pct"),
        F.col("churn_rate_pct").alias("monthly_churn_pct"),
        F.lit(int(months)).alias("months"),
    ).select(*SCENARIOS.names)


def seeded_scenarios(
    mrr: DataFrame, tenants: DataFrame, plan_churn: DataFrame, growth_pct: float = 4.0, months: int = 12
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` scenarios per plan: seeds pass the same ranges as scenarios that users enter."""
    return split_scenarios(plan_scenarios(mrr, tenants, plan_churn, growth_pct, months))

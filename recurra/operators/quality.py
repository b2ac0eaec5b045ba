"""Declared constraints as checks over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column defaults of the event log and of subscriptions.
EVENT_DEFAULTS = {"amount": 0, "currency": "INR", "status": "success", "trial": False}
SUBSCRIPTION_DEFAULTS = {"seats": 1}
# End of fixed values.


def duplicate_keys(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """How many key values occur more than once, and the surplus rows.

    Keys with a NULL part are skipped, as for a unique constraint.
    """
    present = df.select(*keys).dropna()
    counted = present.groupBy(*keys).agg(F.count("*").alias("copies"))
    surplus = F.when(F.col("copies") > 1, F.col("copies") - 1)
    return counted.agg(
        F.count(surplus).alias("duplicate_keys"), F.coalesce(F.sum(surplus), F.lit(0)).alias("surplus_rows")
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "*")


def _per_column(df: DataFrame, table: str, tests: dict, name: str) -> DataFrame:
    """Count rows per test in one pass and turn the counts into rows."""
    counts = df.agg(*[F.count_if(test).alias(column) for column, test in tests.items()])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias(name)) for c in tests]
    return counts.select(F.explode(F.array(*entries)).alias("entry")).select(
        F.lit(table).alias("table_name"), "entry.*"
    )


def null_counts(df: DataFrame, table: str, required: list[str]) -> DataFrame:
    """NULLs per required column, zero counts included."""
    return _per_column(df, table, {c: F.col(c).isNull() for c in required}, "null_rows")


def domain_violations(df: DataFrame, table: str, allowed: dict[str, list[str]]) -> DataFrame:
    """Values outside the allowed set per column; NULL passes, as for ``CHECK``."""
    return _per_column(df, table, {c: ~F.col(c).isin(v) for c, v in allowed.items()}, "violations")


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign-key values without a parent and how many rows carry them.

    Children are counted per value first, so the anti-join sees each value
    once, however many rows a single value has.
    """
    values = child.groupBy(F.col(foreign_key).alias("key_value")).agg(F.count("*").alias("orphan_rows"))
    parents = parent.select(F.col(key).alias("key_value"))
    return values.filter(F.col("key_value").isNotNull()).join(parents, "key_value", "left_anti")


def with_defaults(df: DataFrame, defaults: dict = EVENT_DEFAULTS) -> DataFrame:
    """NULLs replaced by the column defaults."""
    return df.fillna(defaults)

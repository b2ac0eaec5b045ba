"""Tenant-scoped views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tenant_scope(df: DataFrame, tenant_id: str | None) -> DataFrame:
    """Rows of one tenant; no tenant means no rows.

    A convenience for building views, not a security boundary.
    """
    return df.filter(F.col("tenant_id") == F.lit(tenant_id).cast("string"))

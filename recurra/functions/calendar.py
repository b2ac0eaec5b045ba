"""Month axis helpers. Months are two ints plus a sortable ``yyyy-MM`` string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def period(year: Column, month: Column) -> Column:
    """``yyyy-MM`` text of a year and a month number."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def month_distance(from_year: Column, from_month: Column, to_year: Column, to_month: Column) -> Column:
    """Whole calendar months between two months; days are ignored."""
    return (to_year - from_year) * 12 + (to_month - from_month)


def month_start(date: Column) -> Column:
    """First day of the month, as a date (never a timestamp)."""
    return F.trunc(date, "month")


def lenient_timestamp(value: Column, dtype: DataType) -> Column:
    """Parse text to a timestamp, NULL where it is not one; other types pass."""
    return F.try_to_timestamp(value) if isinstance(dtype, StringType) else value

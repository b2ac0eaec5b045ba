"""Guarded ratios and exact half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, and 0.0 where ``whole`` is not positive or NULL."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def fixed_text(value: Column, digits: int) -> Column:
    """A number with a fixed count of decimals, ties of its exact value to even.

    ``format_number`` rounds the binary value itself. ``round``, ``bround`` and
    ``format_string`` start from the shortest decimal text, so they take 6.35
    (in truth 6.3499999...) for a tie.
    """
    pattern = "0" + ("." + "0" * digits if digits else "")
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def round_half_even(value: Column, digits: int) -> Column:
    """Round the exact binary value of a double, ties to even.

    The scaled value decides where it is clearly off a tie: below 2**40 the
    product is wrong by less than 0.0002. Only what remains takes the slower
    way over text. ``value`` is used several times, so pass a column rather
    than a long expression. ``digits`` is 0 to 2.
    """
    scale = float(10**digits)
    scaled = value.cast("double") * scale
    off_tie = F.abs(scaled - F.floor(scaled) - 0.5) > 0.001
    return F.when((F.abs(scaled) < 2.0**40) & off_tie, F.rint(scaled) / scale).otherwise(
        fixed_text(value, digits).cast("double")
    )

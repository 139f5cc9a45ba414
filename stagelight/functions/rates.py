"""Ratios of aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` of whole numbers, rounded half away from zero; NULL when ``whole`` is 0 or NULL.

    The quotient is rounded in integers and only the result becomes a double, so a tie is a tie whatever its binary
    fraction. ``whole`` is not negative; ``part`` may have 18 digits less ``digits``.
    """
    scale = 10**digits
    part, whole = part.cast("long"), F.nullif(whole.cast("long"), F.lit(0).cast("long"))
    doubled = F.abs(part) * F.lit(2 * scale).cast("long") + whole
    units = F.call_function("div", doubled, whole * 2) * F.signum(part).cast("long")
    return units / F.lit(float(scale))


def rate(part: Column, whole: Column) -> Column:
    """``part / whole`` to 3 decimals; NULL when ``whole`` is 0 or NULL. May exceed 1."""
    return rounded_ratio(part, whole, 3)


def nonzero(count: Column) -> Column:
    """A count, with NULL instead of 0."""
    return F.nullif(count, F.lit(0))

"""Rounding and ratios that agree with exact decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(value: Column, places: int = 2) -> Column:
    """Round half away from zero, through a decimal, so binary noise does not decide ties.

    Doubles of a thousand million and more have no such noise at these places; they are rounded as they are.
    """
    exact = F.round(F.when(F.abs(value) < 1e9, value).cast("decimal(20,10)"), places).cast("double")
    return F.when(F.abs(value) < 1e9, exact).otherwise(F.round(value.cast("double"), places))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``100 * part / whole`` rounded; NULL when ``whole`` is zero."""
    return round_exact(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), places)


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds (NULL does not count)."""
    return F.count(F.when(condition, F.lit(1)))

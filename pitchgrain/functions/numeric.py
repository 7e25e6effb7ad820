"""Exact arithmetic: ratios, averages and rounding on decimals instead of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_ratio(part: Column, whole: Column) -> Column:
    """part / whole with 18 decimal places; NULL when whole is 0."""
    return part.cast("decimal(20,0)") / F.nullif(whole.cast("decimal(20,0)"), F.lit(0))


def exact_avg(value: Column) -> Column:
    """Average over decimals, so a tie is a tie when it is rounded afterwards."""
    return F.avg(value.cast("decimal(28,10)"))


def sum_where(condition: Column, value: Column) -> Column:
    """NULL when no row matches, as an aggregate filter gives."""
    return F.sum(F.when(condition, value))


def is_true(flag: Column) -> Column:
    """Three-valued flag read as 'is it true': NULL counts as no."""
    return F.coalesce(flag, F.lit(False))

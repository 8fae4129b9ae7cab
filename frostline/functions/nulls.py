"""Strict aggregates: null as soon as one input is null, as ``na.rm = FALSE`` does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def no_nan(x: Column) -> Column:
    """NaN and infinities become null, so no later comparison sees them."""
    x = x.cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), None).otherwise(x)


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, null when ``b`` is zero."""
    return a / F.nullif(b, F.lit(0.0))


def complete(x: Column) -> Column:
    """True when the group holds no null ``x``."""
    return F.count(x) == F.count(F.lit(1))


def strict(agg: Column, x: Column) -> Column:
    """``agg`` when every ``x`` of the group is present, else null."""
    return F.when(complete(x), agg)


def strict_mean(x: Column) -> Column:
    return strict(F.avg(x), x)


def strict_sum(x: Column) -> Column:
    return strict(F.sum(x), x)


def strict_min(x: Column) -> Column:
    return strict(F.min(x), x)


def strict_max(x: Column) -> Column:
    return strict(F.max(x), x)


def strict_range(x: Column) -> Column:
    return strict(F.max(x) - F.min(x), x)


def strict_count_if(condition: Column) -> Column:
    """Number of rows meeting ``condition``; null if it is unknown for any row."""
    return strict(F.sum(condition.cast("int")), condition)


def strict_quantile(x: Column, p: float) -> Column:
    return strict(F.percentile(x, F.lit(p)), x)


def thermal_sum(x: Column, threshold: float, above: bool = True) -> Column:
    """Sum of the values at or beyond ``threshold`` (the values, not the excess over it)."""
    hit = (x >= threshold) if above else (x <= threshold)
    return strict(F.sum(F.when(hit, x).otherwise(F.lit(0.0))), x)

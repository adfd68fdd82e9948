"""Exact aggregates: rounding is done on integers, so it never depends on binary fractions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_ratio(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` rounded half up to ``digits``, for non-negative integers; null if den is 0."""
    n = num.cast("decimal(30,0)") * F.lit(10 ** digits).cast("decimal(5,0)")
    d = F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    whole = F.call_function("div", n * 2 + d, d * 2)
    return (whole.cast("decimal(20,0)") / F.lit(10 ** digits)).cast(f"decimal(20,{digits})")


def percentage(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with two decimals; null when ``whole`` is 0."""
    return half_up_ratio(part.cast("decimal(20,0)") * 100, whole, 2)


def rounded_mean(total: Column, count: Column, scale: int, digits: int) -> Column:
    """Mean of values that carry ``scale`` decimals, rounded half up to ``digits``."""
    units = (total * F.lit(10 ** scale).cast("decimal(5,0)")).cast("decimal(30,0)")
    return half_up_ratio(units, count.cast("decimal(15,0)") * 10 ** scale, digits)


def mean(total: Column, count: Column) -> Column:
    """Unrounded mean as double; null when there is nothing to average."""
    return total.cast("double") / F.nullif(count, F.lit(0).cast("bigint"))


def count_when(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))

"""Percentiles under their three rules, rounding and safe division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(a: Column, b: Column) -> Column:
    """a / b, 0.0 where b is 0 or null."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def is_finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def finite_mean(v: Column) -> Column:
    """Aggregate: mean of the finite values, null without any."""
    return F.avg(F.when(is_finite(v), v))


def linear_percentile(v: Column, p: float) -> Column:
    """Aggregate: linear between the two nearest values."""
    return F.percentile(v, F.lit(p))


def _sorted(v: Column) -> Column:
    return F.array_sort(F.collect_list(v))


def ceil_percentile(v: Column, p: float) -> Column:
    """Aggregate: the value of rank ceil(p * n), 1 at least. For groups that fit into a task."""
    values = _sorted(v)
    return F.try_element_at(values, F.greatest(F.ceil(F.round(F.size(values) * F.lit(p), 9)), F.lit(1)).cast("int"))


def lower_median(v: Column) -> Column:
    """Aggregate: the value at position (n - 1) / 2, rounded down."""
    values = _sorted(v)
    return F.try_element_at(values, (F.floor((F.size(values) - 1) / 2) + 1).cast("int"))

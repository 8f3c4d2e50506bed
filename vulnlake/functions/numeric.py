"""Rounded shares, averages and ratios as JVM-side column expressions.

Rounding is HALF_UP (Spark's ``round``). Shares are computed in exact decimal arithmetic, as SQL's
``ROUND(100.0 * a / b, d)`` does; every division is guarded so ANSI mode never raises on a zero denominator.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def _hundred() -> Column:
    return F.lit(Decimal("100.0"))


def _one() -> Column:
    return F.lit(Decimal("1.0"))


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``ROUND(100.0 * numerator / denominator, digits)`` in decimal; NULL when the denominator is 0."""
    return F.round(F.try_divide(_hundred() * numerator, denominator), digits)


def share_of_total(count_col: str | Column, digits: int = 2) -> Column:
    """Percent of the column total over all rows of an (already aggregated) frame: ``SUM(c) OVER ()``. The
    window holds one row per group in one task, so it is for columns of few values (bands, states, days)."""
    c = F.col(count_col) if isinstance(count_col, str) else count_col
    return percent(c, F.sum(c).over(Window.partitionBy()), digits)


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``ROUND(numerator * 1.0 / NULLIF(denominator, 0), digits)``."""
    return F.round(F.try_divide(numerator * _one(), F.nullif(denominator, F.lit(0))), digits)


def avg_rounded(col: str | Column, digits: int = 2) -> Column:
    return F.round(F.avg(col), digits)


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``: 0 when no row matches, NULL when there are no rows."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def label_at_least(value: Column, bounds, labels, strict: bool = False) -> Column:
    """First label whose bound ``value`` reaches (``>=``, or ``>`` when strict); the last label otherwise."""
    expr = None
    for bound, label in zip(bounds, labels):
        cond = value > bound if strict else value >= bound
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(labels[len(bounds)])

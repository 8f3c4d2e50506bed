"""Series of days: moving averages over calendar ranges and gaps between active days. Windows run over one row per key
and day, never over raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_rows(df: DataFrame, time: str, keys: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """``day``, the keys, ``n_rows`` and, with ``value``, ``total`` (its sum) and ``n_values``."""
    rows = df.where(F.col(time).isNotNull()).groupBy(F.to_date(time).alias("day"), *keys)
    sums = [F.sum(value).alias("total"), F.count(value).alias("n_values")] if value else []
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def moving_average(daily: DataFrame, days: int = 30, keys: Sequence[str] = ()) -> DataFrame:
    """``daily`` with ``rows_in_range`` of the ``days`` calendar days up to each active day (days without rows count as zero),
    ``rows_per_day`` over them, and ``active_days`` among them."""
    span = Window.partitionBy(*keys).orderBy(F.datediff("day", F.lit("1970-01-01").cast("date"))).rangeBetween(-(days - 1), 0)
    counted = daily.withColumns({"rows_in_range": F.sum("n_rows").over(span), "active_days": F.count(F.lit(1)).over(span)})
    return counted.withColumn("rows_per_day", F.col("rows_in_range") / F.lit(days))


def activity_gaps(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``daily`` with the neighbouring active days: ``days_since`` the one before, ``days_until`` the one after, and ``change``
    of ``n_rows`` against the one before (NULL at the ends)."""
    w = Window.partitionBy(*keys).orderBy("day")
    return daily.withColumns({"days_since": F.datediff("day", F.lag("day").over(w)), "days_until": F.datediff(F.lead("day").over(w), "day"),
                              "change": F.col("n_rows") - F.lag("n_rows").over(w)})

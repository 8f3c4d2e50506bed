"""Difference of two loads of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digest(cols: Sequence[str], seed: int) -> Column:
    # a hash passes over NULLs, so what is NULL is hashed beside it
    parts = [p for c in cols for p in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")


def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str] | str, compare: Sequence[str] | None = None) -> DataFrame:
    """The keys that differ between two loads: ``change`` (added, removed or changed), ``rows_before`` and ``rows_after``.

    A key may have several rows; their order does not matter, their number does. Both loads go through one aggregation of row
    digests (two 64-bit hashes each, summed), combined map-side, instead of joins: a hot key is one row per task, and no text
    is shuffled. ``compare``: the columns compared, by default all of ``old``. A NULL key is a key.
    """
    key = [key] if isinstance(key, str) else list(key)
    cols = [c for c in (compare or old.columns) if c not in key]

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*key, F.lit(sign).alias("_side"), _digest(cols, 1).alias("_a"), _digest(cols, 2).alias("_b"))

    both = side(old, 0).unionByName(side(new, 1))
    zero = F.lit(0).cast("decimal(38,0)")

    def balance(c: str) -> Column:
        return F.sum(F.when(F.col("_side") == 1, F.col(c)).otherwise(-F.col(c)))

    per_key = both.groupBy(*key).agg(F.count(F.when(F.col("_side") == 0, 1)).alias("rows_before"), F.count(F.when(F.col("_side") == 1, 1)).alias("rows_after"),
                                     balance("_a").alias("_a"), balance("_b").alias("_b"))
    change = (F.when(F.col("rows_before") == 0, F.lit("added")).when(F.col("rows_after") == 0, F.lit("removed"))
              .when((F.col("rows_before") != F.col("rows_after")) | (F.col("_a") != zero) | (F.col("_b") != zero), F.lit("changed")))
    return per_key.withColumn("change", change).where(F.col("change").isNotNull()).select(*key, "change", "rows_before", "rows_after")

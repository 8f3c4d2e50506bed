"""Pipeline quality checks returned as DataFrames (Q1-Q7) instead of console prints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.numeric import percent, ratio


def coverage(df: DataFrame, cols, digits: int = 1) -> DataFrame:
    """One pass: total rows, and per column the non-NULL count and its percentage."""
    n = F.count(F.lit(1))
    aggs = [n.alias("total_rows")]
    for c in cols:
        aggs += [F.count(c).alias(f"{c}_present"), percent(F.count(c), n, digits).alias(f"{c}_percent")]
    return df.agg(*aggs)


def distribution(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def expansion_ratio(before: DataFrame, after: DataFrame, digits: int = 2) -> DataFrame:
    """Input records, output rows and their ratio (0 when there is no input). The two counts are one-row
    aggregates stacked and collapsed, so no join is planned."""
    stacked = (before.agg(F.count(F.lit(1)).alias("input_records"))
               .unionByName(after.agg(F.count(F.lit(1)).alias("output_rows")), allowMissingColumns=True))
    both = stacked.agg(F.max("input_records").alias("input_records"), F.max("output_rows").alias("output_rows"))
    return both.withColumn("expansion_ratio",
                           F.coalesce(ratio(F.col("output_rows"), F.col("input_records"), digits), F.lit(0)))


def table_stats(df: DataFrame, distinct_cols=("vendor_name", "product_name")) -> DataFrame:
    """Rows and, per column, distinct values counting NULL as one value (like ``select(c).distinct().count()``)."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for c in distinct_cols:
        has_null = F.max(F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0)))
        aggs.append((F.count_distinct(c) + F.coalesce(has_null, F.lit(0))).alias(f"distinct_{c}"))
    return df.agg(*aggs)


def orphan_keys(child: DataFrame, parent: DataFrame, key: str = "cve_id") -> DataFrame:
    """Distinct child keys with no parent row (a NULL child key is an orphan)."""
    return child.select(key).distinct().join(parent.select(key), key, "left_anti")


def integrity_status(child: DataFrame, parent: DataFrame, key: str = "cve_id") -> DataFrame:
    n = F.count(F.lit(1))
    return orphan_keys(child, parent, key).agg(
        n.alias("orphan_keys"),
        F.when(n == 0, F.lit(S.INTEGRITY_PASSED)).otherwise(F.lit(S.INTEGRITY_WARN)).alias("status"))


def leaderboard(df: DataFrame, entity: str = "vendor_name", key: str = "cve_id", n: int = 15) -> DataFrame:
    return (df.groupBy(entity).agg(F.count_distinct(key).alias("unique_vulnerabilities"),
                                   F.count(F.lit(1)).alias("total_entries"))
              .orderBy(F.desc("unique_vulnerabilities"), F.asc(entity)).limit(n))


def layer_counts(layers: dict) -> DataFrame:
    """``{label: df}`` -> one row per layer with its row count (``UNION ALL`` of one-row aggregates)."""
    parts = [df.agg(F.lit(label).alias("layer"), F.count(F.lit(1)).alias("records")) for label, df in layers.items()]
    return reduce(DataFrame.unionByName, parts)

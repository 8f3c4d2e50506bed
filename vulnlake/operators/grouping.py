"""Groupings beyond one key: grouping sets, the top rows of each group, exact percentiles, mergeable distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

SKETCH_BITS = 12  # 2 ** 12 registers: a relative standard error of 1.04 / 64
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)  # stated error: three standard errors


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], *aggs: Column) -> DataFrame:
    """One row per group of each set of columns. Columns that a set lacks are NULL there; ``set_id`` tells them from groups of
    NULL: bit k (from the right, by the columns' order of first mention) is 1 where column k is summed over."""
    cols = list(dict.fromkeys(c for s in sets for c in s))
    flags = sum((F.grouping(c).cast("int") * (1 << k) for k, c in enumerate(cols)), F.lit(0))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(flags.cast("int").alias("set_id"), *aggs)


def cube(df: DataFrame, cols: Sequence[str], *aggs: Column) -> DataFrame:
    """``grouping_sets`` over every subset of ``cols``."""
    return grouping_sets(df, [[c for k, c in enumerate(cols) if not number >> k & 1] for number in range(1 << len(cols))], *aggs)


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group. Each task keeps its own first ``n`` per group before the shuffle
    (WindowGroupLimit), so a hot group ships ``n`` rows per task. ``order`` should be total, else ties are cut at will."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, shares: Sequence[float], slices: int | None = None) -> DataFrame:
    """For every group and share p the smallest value with at least p of the group's values at or below it (NULLs are not
    values): the keys, ``share``, ``value`` and ``n``.

    Values become a histogram first (one row per group and value, summed map-side), which is dealt by ranges of group and value:
    a hot group is cut into slices. How many values lie in the slices before is a window over one row per group and slice;
    only the slice in which a rank falls looks for it. No group meets in one task.
    """
    by, spark = list(by), df.sparkSession
    histogram = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    path = scratch_path(spark, "histogram")
    (histogram.repartitionByRange(slices or int(spark.conf.get("spark.sql.shuffle.partitions")), *by, "_v")
     .withColumn("_slice", F.spark_partition_id()).write.parquet(path))  # a slice's number must not change under a retry
    histogram = spark.read.parquet(path)

    group = Window.partitionBy(*by)
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = histogram.groupBy(*by, "_slice").agg(F.sum("_n").alias("_in"))
    ranges = per_slice.select(*by, "_slice", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"), "_in", F.sum("_in").over(group).alias("n"))
    share = F.explode(F.array(*[F.lit(float(p)) for p in shares])).alias("share")
    # the rank, from 1: n less the whole number of values that lie above
    rank = F.greatest(F.lit(1), F.col("n") - F.floor(F.col("n") - F.col("share") * F.col("n"))).cast("bigint")
    wanted = ranges.select("*", share).withColumn("_rank", rank).where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_in")))
    wanted = wanted.groupBy(*by, "_slice").agg(F.first("_before").alias("_before"), F.first("n").alias("n"),
                                               F.collect_list(F.struct("share", "_rank")).alias("_wanted"))  # one entry per share
    wanted = wanted.select(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(by)], F.col("_slice").alias("_ws"), "_before", "n", "_wanted")
    same = F.col("_slice") == F.col("_ws")
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"_w{i}"))
    upto = F.sum("_n").over(Window.partitionBy(*by, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = histogram.join(wanted, same).withColumn("_upto", F.col("_before") + upto)
    found = found.select(*by, F.col("_v").alias("value"), "n", "_n", "_upto", F.explode("_wanted").alias("_w"))
    return (found.where((F.col("_w._rank") <= F.col("_upto")) & (F.col("_w._rank") > F.col("_upto") - F.col("_n")))
            .select(*by, F.col("_w.share").alias("share"), "value", "n"))


def distinct_sketches(df: DataFrame, by: Sequence[Column | str], key: str) -> DataFrame:
    """One row per group with ``sketch``, a HyperLogLog sketch of the distinct ``key`` values (NULL is none), and ``n_rows``. Sketches
    of any groups can be united later without the rows: store them."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(key), F.lit(SKETCH_BITS)).alias("sketch"), F.count(F.lit(1)).alias("n_rows"))


def united_distinct(sketches: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """``estimate`` of the distinct keys in all rows behind each group of ``sketches``, within ``SKETCH_ERROR`` (a share) in 99.7 %
    of cases, and ``n_rows``."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"), F.sum("n_rows").alias("n_rows"))

"""Validation reports between the two silver tables: key coverage (G8.1), orphan rows (G8.2),
duplicate keys (G8.3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


def key_coverage(aff: DataFrame, core: DataFrame, key: str = "cve_id", method: str = "union") -> DataFrame:
    """Distinct non-NULL keys on each side and their difference (affected minus core).

    ``method="join"`` is the ``FULL OUTER JOIN`` form, over the distinct keys of each side (a hot key is one
    row before the join, which could not split it). The default ``"union"`` gives the same numbers
    (every non-NULL key of either side survives a full outer join) with no join at all: tag each side's keys,
    aggregate per key (partial aggregation collapses a hot key map-side), then sum the flags.
    """
    if method == "join":
        a = aff.select(F.col(key).alias("_a")).distinct()
        c = core.select(F.col(key).alias("_c")).distinct()
        j = a.join(c, F.col("_a") == F.col("_c"), "full")
        na, nc = F.count("_a"), F.count("_c")
        return j.agg(F.lit(S.INTEGRITY_LABEL).alias("check_type"), na.alias("cves_in_affected_products"),
                     nc.alias("cves_in_core_table"), (na - nc).alias("difference"))
    tagged = (aff.select(F.col(key).alias("_k"), F.lit(1).alias("_in_a"), F.lit(0).alias("_in_c"))
              .unionByName(core.select(F.col(key).alias("_k"), F.lit(0).alias("_in_a"), F.lit(1).alias("_in_c"))))
    per_key = tagged.filter(F.col("_k").isNotNull()).groupBy("_k").agg(F.max("_in_a").alias("_a"),
                                                                       F.max("_in_c").alias("_c"))
    na = F.coalesce(F.sum("_a").cast("bigint"), F.lit(0).cast("bigint"))
    nc = F.coalesce(F.sum("_c").cast("bigint"), F.lit(0).cast("bigint"))
    return per_key.agg(F.lit(S.INTEGRITY_LABEL).alias("check_type"), na.alias("cves_in_affected_products"),
                       nc.alias("cves_in_core_table"), (na - nc).alias("difference"))


def orphan_rows(aff: DataFrame, core: DataFrame, key: str = "cve_id") -> DataFrame:
    """Affected rows whose key has no core row (``LEFT ANTI JOIN``; NULL keys never match, so they count)."""
    return aff.join(core.select(key), key, "left_anti")


def orphan_count(aff: DataFrame, core: DataFrame, key: str = "cve_id") -> DataFrame:
    return orphan_rows(aff, core, key).agg(F.lit(S.ORPHAN_LABEL).alias("validation_check"),
                                           F.count(F.lit(1)).alias("orphaned_count"))


def duplicate_keys(df: DataFrame, key: str = "cve_id") -> DataFrame:
    """Keys occurring more than once (NULL is a key), most frequent first."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrence_count"))
              .filter(F.col("occurrence_count") > 1).orderBy(F.desc("occurrence_count")))

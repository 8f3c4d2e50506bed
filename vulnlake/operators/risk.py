"""Score and risk reports: band profile (G3.1/E3.1), version usage (G3.2/E3.2), severity profile
(G3.3/E3.3) and the top-scored records (G3.4/E3.4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.numeric import avg_rounded, count_when, share_of_total


def _severity_rank(col: str, order=S.SEVERITY_ORDER):
    expr = None
    for i, label in enumerate(order, start=1):
        expr = F.when(F.col(col) == label, i) if expr is None else expr.when(F.col(col) == label, i)
    return expr.otherwise(len(order) + 1)


def band_profile(df: DataFrame, band: str = "risk_category", score: str = "cvss_base_score",
                 out_name: str = "risk_category", drop_null: bool = False, order=S.SEVERITY_ORDER,
                 digits: int = 2) -> DataFrame:
    """Count, share, average/min/max score per band, in severity order. ``band="cvss_severity_rating"``
    (reported as ``risk_category``) with ``drop_null`` is the exploratory form."""
    src = df.filter(F.col(band).isNotNull()) if drop_null else df
    grouped = (src.groupBy(F.col(band).alias(out_name))
                  .agg(F.count(F.lit(1)).alias("cve_count"), avg_rounded(score, digits).alias("avg_cvss_in_category"),
                       F.min(score).alias("min_score"), F.max(score).alias("max_score")))
    return (grouped.select(out_name, "cve_count", share_of_total("cve_count", digits).alias("percentage"),
                           "avg_cvss_in_category", "min_score", "max_score")
                   .orderBy(_severity_rank(out_name, order)))


def version_usage(df: DataFrame, version: str = "cvss_version_used", score: str = "cvss_base_score",
                  band: str = "risk_category", levels=("CRITICAL",), drop_null: bool = False,
                  digits: int = 2) -> DataFrame:
    src = df.filter(F.col(version).isNotNull()) if drop_null else df
    grouped = src.groupBy(version).agg(
        F.count(F.lit(1)).alias("usage_count"), avg_rounded(score, digits).alias("average_score"),
        *[count_when(F.col(band) == lvl).alias(f"{lvl.lower()}_vulnerabilities") for lvl in levels])
    return (grouped.select(version, "usage_count", share_of_total("usage_count", digits).alias("usage_percentage"),
                           "average_score", *[f"{lvl.lower()}_vulnerabilities" for lvl in levels])
                   .orderBy(F.desc("usage_count")))


def severity_profile(df: DataFrame, rating: str = "cvss_severity_rating", score: str = "cvss_base_score",
                     exclude: str = "UNKNOWN", digits: int = 2) -> DataFrame:
    """Per rating other than ``exclude`` (NULL drops out too): count, score stats, share of the remaining rows."""
    grouped = (df.filter(F.col(rating) != exclude).groupBy(rating)
                 .agg(F.count(F.lit(1)).alias("count"), avg_rounded(score, digits).alias("avg_score"),
                      F.min(score).alias("min_score"), F.max(score).alias("max_score")))
    return (grouped.select(rating, "count", "avg_score", "min_score", "max_score",
                           share_of_total("count", digits).alias("percentage"))
                   .orderBy(F.desc("avg_score")))


def top_records(df: DataFrame, n: int = 20, preview: int = 100, key: str = "cve_id", score: str = "cvss_base_score",
                ts: str = "published_timestamp", rating_alias: str = "cvss_severity_rating",
                with_assigner: bool = False) -> DataFrame:
    """Top-``n`` scored records (score desc, newest first, id asc) with a text preview: a bounded top-k
    (``TakeOrderedAndProject``), never a global sort."""
    cols = [key, score, F.col("cvss_severity_rating").alias(rating_alias), "risk_category",
            F.to_date(ts).alias("published_date")]
    if with_assigner:
        cols.append(F.col("assigning_org_name").alias("assigned_by"))
    cols.append(F.substring("cve_description", 1, preview).alias("description_preview"))
    return (df.filter(F.col(score).isNotNull())
              .orderBy(F.desc_nulls_last(score), F.desc_nulls_last(ts), F.asc_nulls_first(key))
              .limit(n).select(*cols))

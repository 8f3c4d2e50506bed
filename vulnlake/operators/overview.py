"""Dataset-level reports: summary (G1.1), completeness (G1.2/E1.2), category share (G1.3/E1.3) and the KPI
row (G9.1/E5.1). Each is a single aggregation pass; shares use a window over the already-grouped rows."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.numeric import avg_rounded, count_when, percent, share_of_total


def dataset_summary(df: DataFrame, key: str = "cve_id", ts: str = "published_timestamp",
                    state: str = "publication_state", published: str = "PUBLISHED", rejected: str = "REJECTED",
                    digits: int = 2) -> DataFrame:
    n_published = F.count(F.when(F.col(state) == published, F.lit(1)))
    return df.agg(
        F.lit(S.SUMMARY_LABEL).alias("metric_category"),
        F.count(F.lit(1)).alias("total_cve_records"),
        F.count_distinct(key).alias("unique_cve_identifiers"),
        F.min(ts).alias("earliest_publication"),
        F.max(ts).alias("latest_publication"),
        F.datediff(F.max(ts), F.min(ts)).alias("coverage_days"),
        n_published.alias("published_cves"),
        F.count(F.when(F.col(state) == rejected, F.lit(1))).alias("rejected_cves"),
        percent(n_published, F.count(F.lit(1)), digits).alias("publish_rate_percent"),
    )


def completeness(df: DataFrame, key: str = "cve_id", cvss_flag: str = "has_cvss",
                 description_flag: str = "has_description", score: str | None = None,
                 digits: int = 2) -> DataFrame:
    """Presence counts and coverage percentages; ``score`` adds the overall average (exploratory form)."""
    n = F.count(F.lit(1))
    with_cvss = count_when(F.col(cvss_flag))
    with_desc = count_when(F.col(description_flag))
    cols = [
        F.lit(S.QUALITY_LABEL).alias("category"),
        n.alias("total_records"),
        count_when(F.col(key).isNotNull()).alias("cve_id_present"),
        with_cvss.alias("cvss_scores_available"),
        with_desc.alias("descriptions_available"),
        percent(with_cvss, n, digits).alias("cvss_coverage_percent"),
        percent(with_desc, n, digits).alias("description_coverage_percent"),
    ]
    if score:
        cols.append(avg_rounded(score, digits).alias("overall_avg_cvss_score"))
    return df.agg(*cols)


def category_share(df: DataFrame, by: str = "publication_state", ts: str = "published_timestamp",
                   drop_null: bool = False, digits: int = 2) -> DataFrame:
    """Count, share of all rows and first/last timestamp per category; NULL is a category unless dropped."""
    src = df.filter(F.col(by).isNotNull()) if drop_null else df
    grouped = src.groupBy(by).agg(F.count(F.lit(1)).alias("cve_count"), F.min(ts).alias("first_occurrence"),
                                  F.max(ts).alias("last_occurrence"))
    return (grouped.select(by, "cve_count", share_of_total("cve_count", digits).alias("percentage"),
                           "first_occurrence", "last_occurrence")
                   .orderBy(F.desc("cve_count")))


def kpi_summary(core: DataFrame, affected: DataFrame, key: str = "cve_id", score: str = "cvss_base_score",
                band: str = "risk_category", ts: str = "published_timestamp", vendor: str = "vendor_name",
                product: str = "product_name", report_time=None, digits: int = 2) -> DataFrame:
    """One KPI row from one aggregate per table (two scans instead of one per scalar subquery).

    The two one-row aggregates are stacked and collapsed with ``max`` (each column is non-NULL in exactly
    one of the two rows), so no join is needed. ``band="cvss_severity_rating"`` plus ``report_time`` gives
    the exploratory variant.
    """
    core_row = core.agg(
        F.count_distinct(key).alias("total_unique_cves"),
        avg_rounded(score, digits).alias("overall_avg_cvss"),
        F.count(F.when(F.col(band) == "CRITICAL", 1)).alias("critical_cves"),  # 0, not NULL, without rows
        F.count(F.when(F.col(band) == "HIGH", 1)).alias("high_risk_cves"),
        F.max(ts).alias("most_recent_publication"),
    )
    affected_row = affected.agg(F.count_distinct(vendor).alias("total_vendors"),
                                F.count_distinct(product).alias("total_products"))
    stacked = core_row.unionByName(affected_row, allowMissingColumns=True)
    cols = [F.lit(S.KPI_TITLE).alias("report_title")] + [
        F.max(c).alias(c) for c in ("total_unique_cves", "total_vendors", "total_products", "overall_avg_cvss",
                                    "critical_cves", "high_risk_cves", "most_recent_publication")]
    out = stacked.agg(*cols)
    if report_time is not None:
        if isinstance(report_time, _dt.datetime):
            report_time = report_time.strftime("%Y-%m-%d %H:%M:%S")
        rt = F.current_timestamp() if report_time == "now" else F.to_timestamp(F.lit(str(report_time)))
        out = out.withColumn("report_generated_at", rt)
    return out

"""Time-based reports: daily (G2.1/E2.1), monthly (G2.2/E2.2), weekday (G2.3), batch days (G6.1),
assigner activity (G6.2), cumulative series (G7.1) and recent activity (G7.2).

All group by a value derived from the event time, so they shuffle only partial aggregates. The running total
of G7.1 is a window over the daily rows (bounded by the number of days, not the number of records).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.numeric import avg_rounded, count_when, label_at_least, share_of_total

LEVELS = ("CRITICAL", "HIGH", "MEDIUM")


def _as_date(as_of) -> Column:
    return F.current_date() if as_of is None else F.to_date(F.lit(str(as_of)))


def _level_counts(band: str, levels, suffix: str):
    return [count_when(F.col(band) == lvl).alias(f"{lvl.lower()}{suffix}") for lvl in levels]


def daily_trend(df: DataFrame, ts: str = "published_timestamp", key: str = "cve_id", band: str = "risk_category",
                levels=LEVELS, score: str | None = None, limit: int | None = None, digits: int = 2) -> DataFrame:
    """Rows, distinct keys and per-level counts per day, newest first. ``score`` adds the daily average,
    ``limit`` keeps the newest N *active* days (exploratory form)."""
    aggs = [F.count(F.lit(1)).alias("daily_cve_count"), F.count_distinct(key).alias("unique_cves_daily"),
            *_level_counts(band, levels, "_count")]
    if score:
        aggs.append(avg_rounded(score, digits).alias("avg_daily_cvss"))
    out = (df.filter(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("publication_date")).agg(*aggs)
             .orderBy(F.desc("publication_date")))
    return out.limit(limit) if limit else out


def monthly_rollup(df: DataFrame, ts: str = "published_timestamp", key: str = "cve_id",
                   score: str = "cvss_base_score", with_min: bool = False, digits: int = 2) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("monthly_total"), F.count_distinct(key).alias("unique_monthly_cves"),
            avg_rounded(score, digits).alias("avg_monthly_cvss"), F.max(score).alias("max_monthly_cvss")]
    if with_min:
        aggs.append(F.min(score).alias("min_monthly_cvss"))
    aggs.append(F.count_distinct(F.to_date(ts)).alias("active_days_in_month"))
    return (df.filter(F.col(ts).isNotNull()).groupBy(F.date_format(ts, "yyyy-MM").alias("publication_month"))
              .agg(*aggs).orderBy(F.desc("publication_month")))


def weekday_pattern(df: DataFrame, ts: str = "published_timestamp", score: str = "cvss_base_score",
                    digits: int = 2) -> DataFrame:
    """Per weekday (1 = Sunday ... 7 = Saturday): count, average, share of all dated rows."""
    names = F.array(*[F.lit(n) for n in S.WEEKDAYS])
    grouped = (df.filter(F.col(ts).isNotNull()).groupBy(F.dayofweek(ts).alias("day_number"))
                 .agg(F.count(F.lit(1)).alias("total_publications"), avg_rounded(score, digits).alias("avg_cvss_score")))
    return (grouped.select("day_number", F.get(names, F.col("day_number") - 1).alias("day_of_week"),
                           "total_publications", "avg_cvss_score",
                           share_of_total("total_publications", digits).alias("percentage_of_total"))
                   .orderBy("day_number"))


def batch_days(df: DataFrame, ts: str = "published_timestamp", key: str = "cve_id", band: str = "risk_category",
               high=("CRITICAL", "HIGH"), score: str = "cvss_base_score", bounds=S.BATCH_BOUNDS,
               labels=S.BATCH_LABELS, digits: int = 2) -> DataFrame:
    """Days labelled by how many records they carry (potential coordinated disclosures), busiest first."""
    grouped = (df.filter(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("publication_date"))
                 .agg(F.count(F.lit(1)).alias("cves_published"), F.count_distinct(key).alias("unique_cves"),
                      count_when(F.col(band).isin(*high)).alias("high_severity_count"),
                      avg_rounded(score, digits).alias("avg_cvss")))
    return (grouped.withColumn("batch_classification", label_at_least(F.col("cves_published"), bounds, labels))
                   .orderBy(F.desc("cves_published"), F.desc("publication_date")))


def org_activity(df: DataFrame, org: str = "assigning_org_name", key: str = "cve_id",
                 score: str = "cvss_base_score", ts: str = "published_timestamp", n: int = 20,
                 digits: int = 2) -> DataFrame:
    """Top-``n`` assigners by records (ties by name), with first/last publication and the span in days."""
    return (df.filter(F.col(org).isNotNull()).groupBy(org)
              .agg(F.count(F.lit(1)).alias("total_assigned"), F.count_distinct(key).alias("unique_cves"),
                   avg_rounded(score, digits).alias("avg_cvss"), F.min(ts).alias("first_assignment"),
                   F.max(ts).alias("last_assignment"), F.datediff(F.max(ts), F.min(ts)).alias("activity_span_days"))
              .orderBy(F.desc("total_assigned"), F.asc(org)).limit(n))


def cumulative_series(df: DataFrame, ts: str = "published_timestamp", score: str = "cvss_base_score", as_of=None,
                      digits: int | None = None) -> DataFrame:
    """Daily count, running total (oldest to newest), daily average (unrounded unless ``digits``) and age in
    days relative to ``as_of`` (default: today)."""
    avg = F.avg(score) if digits is None else avg_rounded(score, digits)
    daily = (df.filter(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("date"))
               .agg(F.count(F.lit(1)).alias("daily_count"), avg.alias("daily_avg_cvss")))
    running = Window.orderBy("date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (daily.select("date", "daily_count", F.sum("daily_count").over(running).alias("cumulative_total"),
                         "daily_avg_cvss", F.datediff(_as_date(as_of), F.col("date")).alias("days_ago"))
                 .orderBy(F.desc("date")))


def recent_activity(df: DataFrame, ts: str = "published_timestamp", score: str = "cvss_base_score",
                    band: str = "risk_category", levels=LEVELS, as_of=None, days: int = 30,
                    digits: int = 2) -> DataFrame:
    """Per day since midnight ``days`` before ``as_of`` (inclusive, no upper bound): counts by level and
    the average. The bound is a constant, so it reaches the scan as a pushed filter."""
    since = F.date_sub(_as_date(as_of), days)
    return (df.filter(F.col(ts) >= since).groupBy(F.to_date(ts).alias("date"))
              .agg(F.count(F.lit(1)).alias("cve_count"), *_level_counts(band, levels, ""),
                   avg_rounded(score, digits).alias("avg_cvss"))
              .orderBy(F.desc("date")))

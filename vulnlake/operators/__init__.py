"""DataFrame operators: silver transforms, quality checks and gold reports."""

from .grouping import cube, distinct_sketches, exact_percentiles, grouping_sets, top_per_group, united_distinct
from .integrity import duplicate_keys, key_coverage, orphan_count, orphan_rows
from .overview import category_share, completeness, dataset_summary, kpi_summary
from .quality import (coverage, distribution, expansion_ratio, integrity_status, layer_counts, leaderboard,
                      orphan_keys, table_stats)
from .risk import band_profile, severity_profile, top_records, version_usage
from .series import activity_gaps, daily_rows, moving_average
from .silver import (affected_products, build_affected, build_core, consolidate_scores, explode_json_objects,
                     extract_json_columns, fill_defaults, merge_duplicates, normalize_timestamps, pick_language,
                     with_band, with_presence_flags, with_processing_time)
from .snapshots import snapshot_diff
from .temporal import asof_join, interval_join, sessions
from .trends import (batch_days, cumulative_series, daily_trend, monthly_rollup, org_activity, recent_activity,
                     weekday_pattern)
from .vendors import critical_detail, portfolio_density, product_priority, vendor_leaderboard, vendor_risk_profile

__all__ = [
    "activity_gaps", "cube", "daily_rows", "distinct_sketches", "exact_percentiles", "grouping_sets", "moving_average", "snapshot_diff",
    "top_per_group", "united_distinct",
    "affected_products", "asof_join", "band_profile", "batch_days", "build_affected", "build_core", "category_share",
    "completeness", "consolidate_scores", "coverage", "critical_detail", "cumulative_series", "daily_trend",
    "dataset_summary", "distribution", "duplicate_keys", "expansion_ratio", "explode_json_objects",
    "extract_json_columns", "fill_defaults", "integrity_status", "interval_join", "key_coverage", "kpi_summary", "layer_counts",
    "leaderboard", "merge_duplicates", "monthly_rollup", "normalize_timestamps", "org_activity", "orphan_count",
    "orphan_keys", "orphan_rows", "pick_language", "portfolio_density", "product_priority", "recent_activity",
    "sessions", "severity_profile", "table_stats", "top_records", "vendor_leaderboard", "vendor_risk_profile",
    "version_usage", "weekday_pattern", "with_band", "with_presence_flags", "with_processing_time",
]

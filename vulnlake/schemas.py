"""Table schemas, defaults, labels and thresholds that results must reproduce exactly."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------------
# Fixed values (must equal the analysed pipeline's for identical results)
# ---------------------------------------------------------------------------------------------------

# Risk bands from the base score, checked top-down: >= 9, >= 7, >= 4, > 0; anything else (NULL, 0).
RISK_BANDS = (("CRITICAL", 9.0, ">="), ("HIGH", 7.0, ">="), ("MEDIUM", 4.0, ">="), ("LOW", 0.0, ">"))
RISK_DEFAULT = "UNSCORED"
SEVERITY_ORDER = ("CRITICAL", "HIGH", "MEDIUM", "LOW")

# Defaults filled after the presence flags are taken.
CORE_DEFAULTS = {
    "cve_description": "[No description provided]",
    "cvss_severity_rating": "UNKNOWN",
    "cvss_version_used": "N/A",
}
AFFECTED_DEFAULTS = {
    "product_name": "[Product name unavailable]",
    "vulnerability_status": "unknown",
}

# CVSS containers read from each metric entry, most preferred first, with the version label reported.
CVSS_VERSIONS = (("3.1", "cvssV3_1"), ("3.0", "cvssV3_0"))
NO_VERSION = "N/A"

# Weekday names for dayofweek() 1..7 (Sunday first).
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Labels of the count-threshold reports (highest first).
PRIORITY_LABELS = ("CRITICAL PRIORITY", "HIGH PRIORITY", "MEDIUM PRIORITY", "LOW PRIORITY")
PRIORITY_BOUNDS = (20, 10, 5)
BATCH_LABELS = ("MAJOR BATCH", "LARGE BATCH", "MEDIUM BATCH", "SMALL BATCH", "SINGLE")
BATCH_BOUNDS = (20, 10, 5, 2)
VENDOR_RISK_LABELS = ("HIGH RISK", "MEDIUM RISK", "LOW RISK")
VENDOR_RISK_BOUNDS = (100, 50)

# Report titles / constant label columns.
SUMMARY_LABEL = "Dataset Overview"
QUALITY_LABEL = "Data Quality Metrics"
INTEGRITY_LABEL = "Referential Integrity"
ORPHAN_LABEL = "Orphaned Products Check"
KPI_TITLE = "CVE Lakehouse Executive Summary"
INTEGRITY_PASSED = "PASSED"
INTEGRITY_WARN = "WARNING"

# JSON paths inside a document.
META_FIELDS = {
    "cve_id": "cveId",
    "publication_state": "state",
    "assigning_org_id": "assignerOrgId",
    "assigning_org_name": "assignerShortName",
}
TIME_FIELDS = {
    "published_timestamp": "datePublished",
    "reserved_timestamp": "dateReserved",
    "updated_timestamp": "dateUpdated",
}
AFFECTED_FIELDS = {
    "vendor_name": "vendor",
    "product_name": "product",
    "vulnerability_status": "defaultStatus",
    "affected_versions_json": "versions",
    "affected_platforms_json": "platforms",
    "vendor_url": "collectionURL",
    "package_identifier": "packageName",
}

# ---------------------------------------------------------------------------------------------------
# Parse schemas (partial on purpose: unlisted fields are ignored)
# ---------------------------------------------------------------------------------------------------

DESCRIPTION_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("value", T.StringType()),
]))

_CVSS = T.StructType([
    T.StructField("baseScore", T.DoubleType()),
    T.StructField("baseSeverity", T.StringType()),
    T.StructField("vectorString", T.StringType()),
])


def metrics_schema(containers=tuple(c for _, c in CVSS_VERSIONS)) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(c, _CVSS) for c in containers]))


AFFECTED_SCHEMA = T.ArrayType(T.MapType(T.StringType(), T.StringType()))

# The part of cveMetadata the core table reads, every field kept as text.
META_SCHEMA = T.StructType([T.StructField(f, T.StringType())
                            for f in list(META_FIELDS.values()) + list(TIME_FIELDS.values())])

# The two sub-documents of containers.cna the core table parses further, kept as JSON text (the rest of the
# document, e.g. the affected array, is skipped by the parser rather than re-serialised).
CNA_SCHEMA = T.StructType([T.StructField("cna", T.StructType([
    T.StructField("descriptions", T.StringType()),
    T.StructField("metrics", T.StringType()),
]))])


CORE_COLUMNS = (
    "cve_id", "publication_state", "assigning_org_id", "assigning_org_name",
    "published_timestamp", "reserved_timestamp", "updated_timestamp", "cve_description",
    "bronze_ingestion_ts", "data_year", "cvss_base_score", "cvss_severity_rating", "cvss_vector",
    "cvss_version_used", "silver_transform_timestamp", "has_description", "has_cvss", "risk_category",
)
AFFECTED_COLUMNS = ("cve_id",) + tuple(AFFECTED_FIELDS) + ("silver_transform_timestamp",)

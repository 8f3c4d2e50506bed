"""Independent DuckDB SQL for every registered query, over the raw test tables.

The silver tables are restated relationally (CTEs ``core_cves`` and ``affected_products``) from the same
binding rules as ``bindings.py``; nothing here parses JSON. Shares and ratios are rounded HALF_UP with exact
integer arithmetic (DuckDB's ``round`` on doubles misses decimal ties), averages with ``round(avg, d)``.
"""

from __future__ import annotations

DIGITS = 6  # averages over small groups (see README, "Rounding")
USER_DIGITS = 2  # shares, ratios and averages over large groups, as users see them
AS_OF = "DATE '2001-08-01'"
EVENTS_AS_OF = "DATE '2024-01-31'"
REPORT_AT = "TIMESTAMP '2001-08-02 00:00:00'"


def pct(a: str, b: str, d: int = USER_DIGITS) -> str:
    """``ROUND(100.0 * a / b, d)`` HALF_UP, exactly, as DOUBLE; NULL when b = 0."""
    return (f"(CASE WHEN ({b}) = 0 THEN NULL ELSE CAST((CAST({a} AS HUGEINT) * {2 * 100 * 10 ** d} + ({b})) "
            f"// (2 * CAST({b} AS HUGEINT)) AS DOUBLE) / {10 ** d} END)")


def ratio(a: str, b: str, d: int = USER_DIGITS) -> str:
    """``ROUND(a * 1.0 / NULLIF(b, 0), d)`` HALF_UP, exactly, as DOUBLE."""
    return (f"(CASE WHEN ({b}) = 0 THEN NULL ELSE CAST((CAST({a} AS HUGEINT) * {2 * 10 ** d} + ({b})) "
            f"// (2 * CAST({b} AS HUGEINT)) AS DOUBLE) / {10 ** d} END)")


def avg(x: str, d: int = DIGITS) -> str:
    return f"round(avg({x}), {d})"


def eq(col: str, value: str) -> str:
    return f"{col} = '{value}'"


def count_if(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def label_case(value: str, bounds, labels, strict: bool = False) -> str:
    op = ">" if strict else ">="
    arms = " ".join(f"WHEN {value} {op} {b} THEN '{lab}'" for b, lab in zip(bounds, labels))
    return f"CASE {arms} ELSE '{labels[len(bounds)]}' END"


def cve_id(key: str, date: str) -> str:
    return f"('CVE-' || CAST(year({date}) AS VARCHAR) || '-' || printf('%07d', {key}))"


SCORE = "CASE WHEN l_linenumber = 7 THEN CAST(0.0 AS DOUBLE) ELSE l_quantity / 5 END"


def band(x: str, default: str) -> str:
    return (f"CASE WHEN {x} >= 9 THEN 'CRITICAL' WHEN {x} >= 7 THEN 'HIGH' WHEN {x} >= 4 THEN 'MEDIUM' "
            f"WHEN {x} > 0 THEN 'LOW' ELSE '{default}' END")


def _parts() -> str:
    cols = []
    for flag, label, tag in (("R", "3.1", "31"), ("A", "3.0", "30")):
        cols += [f"max(sc) FILTER (WHERE l_returnflag = '{flag}') AS s{tag}",
                 f"max(sev) FILTER (WHERE l_returnflag = '{flag}') AS v{tag}",
                 f"max('CVSS:{label}/' || CAST(l_linenumber AS VARCHAR)) FILTER (WHERE l_returnflag = '{flag}') AS x{tag}"]
    return ", ".join(cols)


# The relational twin of the two silver tables (plus per-order helpers), as CTEs.
TWIN = f"""
ord AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority, o.o_orderdate, c.c_nationkey, c.c_acctbal, n.n_name,
         CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW' THEN NULL
              ELSE o.o_orderdate + to_seconds(o.o_orderkey % 86400) END AS pub
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
scored AS (
  SELECT l_orderkey, l_returnflag, l_linenumber, {SCORE} AS sc, {band(SCORE, 'NONE')} AS sev FROM lineitem),
parts AS (SELECT l_orderkey, {_parts()} FROM scored GROUP BY l_orderkey),
core_raw AS (
  SELECT {cve_id('o.o_orderkey', 'o.o_orderdate')} AS cve_id,
    CASE WHEN o.o_orderstatus = 'F' THEN 'REJECTED' ELSE 'PUBLISHED' END AS publication_state,
    'org-' || CAST(o.c_nationkey AS VARCHAR) AS assigning_org_id,
    CASE WHEN o.c_acctbal >= 0 THEN o.n_name END AS assigning_org_name,
    o.pub AS published_timestamp,
    o.pub - INTERVAL 30 DAY AS reserved_timestamp,
    o.pub + to_days(CAST(o.o_orderkey % 10 AS INTEGER)) AS updated_timestamp,
    CASE WHEN o.o_orderpriority <> '4-NOT SPECIFIED'
         THEN 'Order ' || CAST(o.o_orderkey AS VARCHAR) || ' ' || o.o_orderpriority END AS descr,
    TIMESTAMP '2001-08-02 00:00:00' AS bronze_ingestion_ts,
    CAST(year(o.o_orderdate) AS INTEGER) AS data_year,
    coalesce(p.s31, p.s30) AS cvss_base_score,
    coalesce(p.v31, p.v30) AS rating,
    coalesce(p.x31, p.x30) AS cvss_vector,
    CASE WHEN p.s31 IS NOT NULL THEN '3.1' WHEN p.s30 IS NOT NULL THEN '3.0' ELSE 'N/A' END AS cvss_version_used,
    o.o_orderkey AS orderkey, o.o_orderpriority AS priority
  FROM ord o LEFT JOIN parts p ON p.l_orderkey = o.o_orderkey),
core_cves AS (
  SELECT cve_id, publication_state, assigning_org_id, assigning_org_name, published_timestamp,
    reserved_timestamp, updated_timestamp, coalesce(descr, '[No description provided]') AS cve_description,
    bronze_ingestion_ts, data_year, cvss_base_score, coalesce(rating, 'UNKNOWN') AS cvss_severity_rating,
    cvss_vector, cvss_version_used, descr IS NOT NULL AS has_description, cvss_base_score IS NOT NULL AS has_cvss,
    {band('cvss_base_score', 'UNSCORED')} AS risk_category
  FROM core_raw),
line_items AS (
  SELECT {cve_id('o.o_orderkey', 'o.o_orderdate')} AS cve_id,
    CASE WHEN s.s_acctbal >= 0 THEN s.s_name END AS vendor,
    CASE WHEN p.p_size <= 48 THEN p.p_name END AS product,
    CASE WHEN l.l_linestatus = 'O' THEN 'affected' END AS status,
    '[{{"version":"' || CAST(l.l_linenumber AS VARCHAR) || '"}}]' AS versions,
    '["' || l.l_linestatus || '"]' AS platforms,
    CASE WHEN s.s_suppkey IS NOT NULL THEN 'https://vendors.test/' || CAST(s.s_suppkey AS VARCHAR) END AS url,
    p.p_brand AS brand
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN part p ON l.l_partkey = p.p_partkey),
vendor_lines AS (
  SELECT {cve_id('o.o_orderkey', 'o.o_orderdate')} AS cve_id, l.l_orderkey AS orderkey, s.s_name AS vendor, s.s_acctbal >= 0 AS named,
    CASE WHEN p.p_size <= 48 THEN p.p_name ELSE '[Product name unavailable]' END AS product,
    CASE WHEN s.s_acctbal >= 5000 THEN p.p_name END AS known_product
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey),
affected_products AS (
  SELECT cve_id, vendor AS vendor_name, coalesce(product, '[Product name unavailable]') AS product_name,
    coalesce(status, 'unknown') AS vulnerability_status, versions AS affected_versions_json,
    platforms AS affected_platforms_json, url AS vendor_url, brand AS package_identifier
  FROM line_items WHERE vendor IS NOT NULL),
strays AS (SELECT 'LOST-' || cve_id AS cve_id FROM line_items WHERE vendor LIKE '%7'),
revised_core AS (
  SELECT * FROM core_cves
  UNION ALL
  SELECT * REPLACE (cve_description || ' (revised)' AS cve_description) FROM core_cves
  WHERE cve_description LIKE '%1-URGENT')
"""


def with_twin(body: str) -> str:
    """``body`` is either a SELECT or further CTEs (starting with a comma) followed by a SELECT."""
    body = body.strip()
    if body.startswith(","):
        return f"WITH {TWIN}{body}"
    return f"WITH {TWIN}\n{body}"


CORE_COLS = ("cve_id, publication_state, assigning_org_id, assigning_org_name, published_timestamp, "
             "reserved_timestamp, updated_timestamp, cve_description, bronze_ingestion_ts, data_year, "
             "cvss_base_score, cvss_severity_rating, cvss_vector, cvss_version_used, has_description, has_cvss, "
             "risk_category")
AFF_COLS = ("cve_id, vendor_name, product_name, vulnerability_status, affected_versions_json, "
            "affected_platforms_json, vendor_url, package_identifier")
D = DIGITS


def _daily_trend(src: str, ts: str, key: str, band_col: str, levels, score: str | None, limit: int | None) -> str:
    level_cols = ", ".join(f"{count_if(eq(band_col, lvl))} AS {lvl.lower()}_count" for lvl in levels)
    avg_col = f", {avg(score)} AS avg_daily_cvss" if score else ""
    lim = f" ORDER BY publication_date DESC LIMIT {limit}" if limit else ""
    return (f"SELECT CAST({ts} AS DATE) AS publication_date, COUNT(*) AS daily_cve_count, "
            f"COUNT(DISTINCT {key}) AS unique_cves_daily, {level_cols}{avg_col} FROM {src} "
            f"WHERE {ts} IS NOT NULL GROUP BY 1{lim}")


def _weekday(src: str, ts: str, score: str) -> str:
    names = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(
        ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"), start=1))
    return (f", wd AS (SELECT CAST(dayofweek({ts}) + 1 AS INTEGER) AS day_number, COUNT(*) AS n, {avg(score, USER_DIGITS)} AS a "
            f"FROM {src} WHERE {ts} IS NOT NULL GROUP BY 1) "
            f"SELECT day_number, CASE day_number {names} END AS day_of_week, n AS total_publications, "
            f"a AS avg_cvss_score, {pct('n', 'SUM(n) OVER ()')} AS percentage_of_total FROM wd")


def _batch_days(src: str, ts: str, key: str, band_col: str, high, score: str, bounds) -> str:
    labels = ("MAJOR BATCH", "LARGE BATCH", "MEDIUM BATCH", "SMALL BATCH", "SINGLE")
    case = " ".join(f"WHEN COUNT(*) >= {b} THEN '{lab}'" for b, lab in zip(bounds, labels))
    high_list = ", ".join(f"'{h}'" for h in high)
    return (f"SELECT CAST({ts} AS DATE) AS publication_date, COUNT(*) AS cves_published, "
            f"COUNT(DISTINCT {key}) AS unique_cves, {count_if(f'{band_col} IN ({high_list})')} AS high_severity_count, "
            f"{avg(score)} AS avg_cvss, CASE {case} ELSE '{labels[-1]}' END AS batch_classification "
            f"FROM {src} WHERE {ts} IS NOT NULL GROUP BY 1")


def _cumulative(src: str, ts: str, score: str, as_of: str) -> str:
    return (f", daily AS (SELECT CAST({ts} AS DATE) AS date, COUNT(*) AS daily_count, {avg(score)} AS daily_avg_cvss "
            f"FROM {src} WHERE {ts} IS NOT NULL GROUP BY 1) "
            f"SELECT date, daily_count, CAST(SUM(daily_count) OVER (ORDER BY date) AS BIGINT) AS cumulative_total, "
            f"daily_avg_cvss, CAST(date_diff('day', date, {as_of}) AS INTEGER) AS days_ago FROM daily")


def _kpi(band_col: str, report: bool) -> str:
    """All distinct things as one set of tagged values, all scores as one group per band, each read once."""
    extra = f", {REPORT_AT} AS report_generated_at" if report else ""
    return (f""", things AS (
  SELECT 'record' AS kind, CAST(o_orderkey AS VARCHAR) AS thing FROM orders
  UNION SELECT 'vendor', vendor FROM line_items WHERE vendor IS NOT NULL
  UNION SELECT 'product', coalesce(product, '[Product name unavailable]') FROM line_items WHERE vendor IS NOT NULL),
kinds AS (SELECT map_from_entries(list((kind, n))) AS m FROM (SELECT kind, count(*) AS n FROM things GROUP BY kind)),
bands AS (
  SELECT {band_col} AS band, count(*) AS n, count(cvss_base_score) AS scored, sum(cvss_base_score) AS total,
         max(published_timestamp) AS latest
  FROM core_cves GROUP BY {band_col})
SELECT 'CVE Lakehouse Executive Summary' AS report_title,
  coalesce(any_value(m['record']), 0) AS total_unique_cves, coalesce(any_value(m['vendor']), 0) AS total_vendors,
  coalesce(any_value(m['product']), 0) AS total_products, round(sum(total) / sum(scored), {DIGITS}) AS overall_avg_cvss,
  CAST(coalesce(sum(n) FILTER (WHERE band = 'CRITICAL'), 0) AS BIGINT) AS critical_cves,
  CAST(coalesce(sum(n) FILTER (WHERE band = 'HIGH'), 0) AS BIGINT) AS high_risk_cves,
  max(latest) AS most_recent_publication{extra}
FROM bands CROSS JOIN kinds""")


def _band_profile(band_col: str, where: str) -> str:
    return (f", g AS (SELECT {band_col} AS risk_category, COUNT(*) AS n, {avg('cvss_base_score', USER_DIGITS)} AS a, "
            f"MIN(cvss_base_score) AS lo, MAX(cvss_base_score) AS hi FROM core_cves {where} GROUP BY 1) "
            f"SELECT risk_category, n AS cve_count, {pct('n', 'SUM(n) OVER ()')} AS percentage, "
            f"a AS avg_cvss_in_category, lo AS min_score, hi AS max_score FROM g")


def _version_usage(band_col: str, levels, where: str) -> str:
    lv = "".join(f", {count_if(eq(band_col, x))} AS {x.lower()}_vulnerabilities" for x in levels)
    names = "".join(f", {x.lower()}_vulnerabilities" for x in levels)
    return (f", g AS (SELECT cvss_version_used, COUNT(*) AS n, {avg('cvss_base_score', USER_DIGITS)} AS a{lv} "
            f"FROM core_cves {where} GROUP BY 1) "
            f"SELECT cvss_version_used, n AS usage_count, {pct('n', 'SUM(n) OVER ()')} AS usage_percentage, "
            f"a AS average_score{names} FROM g")


def _top_records(assigner: bool, rating_alias: str) -> str:
    extra = ", assigning_org_name AS assigned_by" if assigner else ""
    return (", ranked AS (SELECT *, row_number() OVER (ORDER BY cvss_base_score DESC NULLS LAST, "
            "published_timestamp DESC NULLS LAST, cve_id ASC NULLS FIRST) AS rk FROM core_cves "
            "WHERE cvss_base_score IS NOT NULL) "
            f"SELECT cve_id, cvss_base_score, cvss_severity_rating AS {rating_alias}, risk_category, "
            f"CAST(published_timestamp AS DATE) AS published_date{extra}, "
            "substring(cve_description, 1, 100) AS description_preview FROM ranked WHERE rk <= 20")


def _vendor_leaderboard(product: str, known: str, n: int) -> str:
    return (f", g AS (SELECT vendor, COUNT(DISTINCT cve_id) AS tv, COUNT(*) AS tpi, COUNT(DISTINCT {product}) AS upa "
            f"FROM vendor_lines WHERE {known} GROUP BY vendor) "
            f"SELECT vendor AS vendor_name, tv AS total_vulnerabilities, tpi AS total_product_instances, "
            f"upa AS unique_products_affected, {ratio('tv', 'upa')} AS avg_cves_per_product FROM g "
            f"ORDER BY tv DESC, vendor ASC LIMIT {n}")


def _portfolio(bounds, vendor: str = "vendor_name", n: int = 20) -> str:
    risk = ""
    if bounds:
        risk = (f", CASE WHEN tv > {bounds[0]} THEN 'HIGH RISK' WHEN tv > {bounds[1]} THEN 'MEDIUM RISK' "
                f"ELSE 'LOW RISK' END AS vendor_risk_level")
    return (f", g AS (SELECT {vendor} AS vendor_name, COUNT(DISTINCT product_name) AS pps, COUNT(DISTINCT cve_id) AS tv "
            f"FROM affected_products WHERE vendor_name IS NOT NULL AND product_name IS NOT NULL GROUP BY 1 "
            f"HAVING COUNT(DISTINCT product_name) >= 3) "
            f"SELECT vendor_name, pps AS product_portfolio_size, tv AS total_vulnerabilities, "
            f"{ratio('tv', 'pps')} AS vulnerability_density{risk} FROM g ORDER BY tv DESC, vendor_name ASC LIMIT {n}")


ORACLES: dict[str, str] = {}


def _reg(name: str, body: str, twin: bool = True) -> None:
    ORACLES[name] = with_twin(body) if twin else body.strip()


# ---- sources -------------------------------------------------------------------------------------
_reg("s01_scan_documents", "SELECT cve_id, publication_state, 'CVE_RECORD' AS data_type FROM core_cves")
ORACLES["s01_scan_documents_stream"] = ORACLES["s01_scan_documents"]
_reg("s02_bronze_columns",
     "SELECT cve_id, 'CVE_RECORD' AS dataType, '5.1' AS dataVersion, TRUE AS has_containers FROM core_cves")
_reg("s03_ingest_metadata",
     "SELECT cve_id, data_year AS _source_year, DATE '2001-08-02' AS _ingestion_date, "
     "TIMESTAMP '2001-08-02 00:00:00' AS _ingestion_timestamp FROM core_cves")
_reg("s04_table_roundtrip",
     "SELECT cve_id, risk_category, cvss_base_score, published_timestamp FROM core_cves")
ORACLES["s04_table_catalog"] = ORACLES["s04_table_roundtrip"]
_reg("s01_scan_documents_files",
     ", rejected AS (SELECT cve_id FROM core_cves WHERE cve_id LIKE '%00') "
     "SELECT cve_id AS name, TRUE AS good, publication_state AS detail FROM core_cves "
     "UNION ALL SELECT cve_id || '-cut', FALSE, 'syntax error' FROM rejected "
     "UNION ALL SELECT cve_id || '-more', FALSE, 'extra data whole' FROM rejected "
     "UNION ALL SELECT cve_id || '-empty', FALSE, 'empty file' FROM rejected "
     "UNION ALL SELECT cve_id || '-list', FALSE, 'not exactly one JSON object: list' FROM rejected")
_reg("s04_table_merge_schema",
     "SELECT cve_id, publication_state, CASE WHEN publication_state = 'PUBLISHED' THEN cvss_base_score END AS cvss_base_score, "
     "CASE WHEN publication_state = 'REJECTED' THEN assigning_org_name END AS assigning_org_name FROM core_cves "
     "WHERE publication_state IN ('PUBLISHED', 'REJECTED')")
_reg("s01_scan_limit", "SELECT unnest(['good', 'documents']) AS kind, least(100, count(*)) AS n FROM orders "
     "UNION ALL SELECT 'rejected', count(*) FROM orders WHERE o_orderpriority = '1-URGENT'", twin=False)
_reg("s05_export_csv", _band_profile("risk_category", ""))
_reg("s06_preview",
     "SELECT " + ", ".join(f"substring({c}, 1, 12) AS {c}" for c in (
         "cve_id", "publication_state", "assigning_org_id", "assigning_org_name",
         "strftime(published_timestamp, '%Y-%m-%d %H:%M:%S')", "strftime(reserved_timestamp, '%Y-%m-%d %H:%M:%S')",
         "strftime(updated_timestamp, '%Y-%m-%d %H:%M:%S')", "cve_description",
         "strftime(bronze_ingestion_ts, '%Y-%m-%d %H:%M:%S')", "CAST(data_year AS VARCHAR)"))
     .replace("AS strftime(published_timestamp, '%Y-%m-%d %H:%M:%S')", "AS published_timestamp")
     .replace("AS strftime(reserved_timestamp, '%Y-%m-%d %H:%M:%S')", "AS reserved_timestamp")
     .replace("AS strftime(updated_timestamp, '%Y-%m-%d %H:%M:%S')", "AS updated_timestamp")
     .replace("AS strftime(bronze_ingestion_ts, '%Y-%m-%d %H:%M:%S')", "AS bronze_ingestion_ts")
     .replace("AS CAST(data_year AS VARCHAR)", "AS data_year") + " FROM core_cves ORDER BY core_cves.cve_id LIMIT 5")
_reg("s06_table_profile",
     "SELECT COUNT(*) AS n_rows, 3 AS n_columns, 'struct<cve_id:string,data_year:int,has_cvss:boolean>' AS schema_ddl FROM orders")

# ---- silver --------------------------------------------------------------------------------------
_reg("t01_extract_json",
     "SELECT data_year, cve_id, publication_state, assigning_org_id, assigning_org_name FROM core_raw")
_reg("t01_extract_json_events", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events", twin=False)
_reg("t02_normalize_timestamps",
     "SELECT cve_id, published_timestamp, reserved_timestamp, updated_timestamp FROM core_raw")
_reg("t03_pick_language", "SELECT cve_id, descr AS cve_description FROM core_raw")
_reg("t04_consolidate_scores",
     "SELECT cve_id, cvss_base_score, rating AS cvss_severity_rating, cvss_vector, cvss_version_used FROM core_raw")
_reg("t05_merge_duplicates", "SELECT cve_id, cvss_base_score, cvss_severity_rating, risk_category FROM core_cves")
_reg("t06_presence_flags", "SELECT cve_id, has_description, has_cvss FROM core_cves")
_reg("t07_risk_band", "SELECT cve_id, cvss_base_score, risk_category FROM core_cves")
_reg("t08_fill_defaults",
     "SELECT cve_id, cve_description, cvss_severity_rating, cvss_version_used FROM core_cves")
_reg("t09_processing_time", f"SELECT cve_id, {REPORT_AT} AS silver_transform_timestamp FROM core_cves")
_reg("t10_explode_json", "SELECT cve_id, vendor, product, status FROM line_items")
_reg("t11_affected_products", f"SELECT {AFF_COLS} FROM affected_products")
_reg("t12_build_core", f"SELECT {CORE_COLS} FROM core_cves")

# ---- quality -------------------------------------------------------------------------------------
_reg("q1_coverage",
     "SELECT COUNT(*) AS total_rows, "
     + ", ".join(f"COUNT({c}) AS {c}_present, {pct(f'COUNT({c})', 'COUNT(*)', 1)} AS {c}_percent"
                 for c in ("cvss_base_score", "published_timestamp", "assigning_org_name"))
     + " FROM core_cves")
_reg("q2_distribution", "SELECT risk_category, COUNT(*) AS count FROM core_cves GROUP BY 1")
_reg("q3_expansion_ratio",
     ", io AS (SELECT (SELECT COUNT(*) FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l "
     "WHERE l.l_orderkey = o.o_orderkey)) AS input_records, (SELECT COUNT(*) FROM affected_products) AS output_rows) "
     f"SELECT input_records, output_rows, coalesce({ratio('output_rows', 'input_records', 2)}, 0) AS expansion_ratio "
     "FROM io")
_reg("q4_table_stats",
     "SELECT COUNT(*) AS total_rows, "
     "COUNT(DISTINCT vendor_name) + MAX(CASE WHEN vendor_name IS NULL THEN 1 ELSE 0 END) AS distinct_vendor_name, "
     "COUNT(DISTINCT product_name) + MAX(CASE WHEN product_name IS NULL THEN 1 ELSE 0 END) AS distinct_product_name "
     "FROM affected_products")
_reg("q5_integrity_status",
     "SELECT COUNT(*) AS orphan_keys, CASE WHEN COUNT(*) > 0 THEN 'WARNING' ELSE 'PASSED' END AS status "
     "FROM (SELECT cve_id FROM strays EXCEPT SELECT cve_id FROM core_cves)")
_reg("q6_leaderboard",
     "SELECT vendor_name, COUNT(DISTINCT cve_id) AS unique_vulnerabilities, COUNT(*) AS total_entries "
     "FROM affected_products GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 15")
_reg("q7_layer_counts",
     "SELECT 'Bronze' AS layer, COUNT(*) AS records FROM orders "
     "UNION ALL SELECT 'Silver - Core CVEs', COUNT(*) FROM core_cves "
     "UNION ALL SELECT 'Silver - Products', COUNT(*) FROM affected_products")

# ---- gold ----------------------------------------------------------------------------------------
_reg("g1_1_dataset_summary",  # orders are unique by key, so records are counted by status alone
     ", by_status AS (SELECT o_orderstatus, count(*) AS n, min(pub) AS first_pub, max(pub) AS last_pub FROM ord GROUP BY o_orderstatus), "
     "t AS (SELECT CAST(sum(n) AS BIGINT) AS n, min(first_pub) AS lo, max(last_pub) AS hi, "
     "CAST(coalesce(sum(n) FILTER (WHERE o_orderstatus = 'F'), 0) AS BIGINT) AS rejected FROM by_status) "
     "SELECT 'Dataset Overview' AS metric_category, n AS total_cve_records, n AS unique_cve_identifiers, "
     "lo AS earliest_publication, hi AS latest_publication, "
     "CAST(date_diff('day', CAST(lo AS DATE), CAST(hi AS DATE)) AS INTEGER) AS coverage_days, "
     f"n - rejected AS published_cves, rejected AS rejected_cves, {pct('(n - rejected)', 'n')} AS publish_rate_percent FROM t")


def _completeness(with_avg: bool) -> str:
    extra = ", a AS overall_avg_cvss_score" if with_avg else ""
    return (f", q AS (SELECT count(*) AS n, count(cve_id) AS ids, count(*) FILTER (WHERE has_cvss) AS sc, "
            f"count(*) FILTER (WHERE has_description) AS ds, {avg('cvss_base_score', USER_DIGITS)} AS a FROM core_cves) "
            "SELECT 'Data Quality Metrics' AS category, n AS total_records, ids AS cve_id_present, "
            "sc AS cvss_scores_available, ds AS descriptions_available, "
            f"{pct('sc', 'n')} AS cvss_coverage_percent, {pct('ds', 'n')} AS description_coverage_percent{extra} FROM q")


def _category_share(by: str, where: str) -> str:
    return (f", g AS (SELECT {by}, COUNT(*) AS n, MIN(published_timestamp) AS f, "
            f"MAX(published_timestamp) AS l FROM core_cves {where} GROUP BY 1) "
            f"SELECT {by}, n AS cve_count, {pct('n', 'SUM(n) OVER ()')} AS percentage, "
            f"f AS first_occurrence, l AS last_occurrence FROM g")


def _monthly(with_min: bool) -> str:
    mn = ", MIN(cvss_base_score) AS min_monthly_cvss" if with_min else ""
    return ("SELECT strftime(published_timestamp, '%Y-%m') AS publication_month, COUNT(*) AS monthly_total, "
            f"COUNT(DISTINCT cve_id) AS unique_monthly_cves, {avg('cvss_base_score')} AS avg_monthly_cvss, "
            f"MAX(cvss_base_score) AS max_monthly_cvss{mn}, "
            "COUNT(DISTINCT CAST(published_timestamp AS DATE)) AS active_days_in_month "
            "FROM core_cves WHERE published_timestamp IS NOT NULL GROUP BY 1")


_reg("g1_2_completeness", _completeness(False))
_reg("g1_3_category_share", _category_share("publication_state", ""))
_reg("g2_1_daily_trend", _daily_trend("core_cves", "published_timestamp", "cve_id", "risk_category",
                                      ("CRITICAL", "HIGH", "MEDIUM"), None, None))
_reg("g2_2_monthly_rollup", _monthly(False))
_reg("g2_3_weekday_pattern", _weekday("core_cves", "published_timestamp", "cvss_base_score"))
_reg("g3_1_band_profile", _band_profile("risk_category", ""))
_reg("g3_2_version_usage", _version_usage("risk_category", ("CRITICAL",), ""))
_reg("g3_3_severity_profile",
     f", g AS (SELECT cvss_severity_rating, COUNT(*) AS n, {avg('cvss_base_score', USER_DIGITS)} AS a, MIN(cvss_base_score) AS lo, "
     "MAX(cvss_base_score) AS hi FROM core_cves WHERE cvss_severity_rating != 'UNKNOWN' GROUP BY 1) "
     f"SELECT cvss_severity_rating, n AS count, a AS avg_score, lo AS min_score, hi AS max_score, "
     f"{pct('n', 'SUM(n) OVER ()')} AS percentage FROM g")
_reg("g3_4_top_records", _top_records(False, "cvss_severity_rating"))
_reg("g4_1_vendor_leaderboard", _vendor_leaderboard("product", "named", 25))
_reg("g4_2_product_priority",
     ", per_order AS (SELECT vendor, product, orderkey, count(*) AS r FROM vendor_lines WHERE named GROUP BY vendor, product, orderkey), "
     "per_pair AS (SELECT vendor, product, count(*) AS k, CAST(sum(r) AS BIGINT) AS r FROM per_order GROUP BY vendor, product), "
     "ranked AS (SELECT *, row_number() OVER (ORDER BY k DESC, vendor, product) AS place FROM per_pair) "
     "SELECT vendor AS vendor_name, product AS product_name, k AS vulnerability_count, r AS total_records, "
     + label_case("k", (20, 10, 5), ("CRITICAL PRIORITY", "HIGH PRIORITY", "MEDIUM PRIORITY", "LOW PRIORITY"))
     + " AS priority_level FROM ranked WHERE place <= 30")
_reg("g4_3_portfolio_density", _portfolio(None))
_reg("g5_1_critical_detail",  # one order is one record: count the distinct names in each order's list of lines
     ", lists AS (SELECT orderkey, list_distinct(list(vendor)) AS vendors, list_distinct(list(product)) AS products "
     "FROM vendor_lines WHERE named GROUP BY orderkey), "
     "critical AS (SELECT cve_id, orderkey, cvss_base_score, published_timestamp, descr FROM core_raw WHERE cvss_base_score >= 9), "
     "counted AS (SELECT c.*, coalesce(len(vendors), 0) AS nv, coalesce(len(products), 0) AS np "
     "FROM critical c LEFT JOIN lists USING (orderkey)), "
     "ranked AS (SELECT *, row_number() OVER (ORDER BY cvss_base_score DESC, nv DESC, cve_id) AS place FROM counted) "
     "SELECT cve_id, cvss_base_score, 'CRITICAL' AS risk_category, CAST(published_timestamp AS DATE) AS published_date, "
     "nv AS affected_vendor_count, np AS affected_product_count, "
     "substring(coalesce(descr, '[No description provided]'), 1, 80) AS description_excerpt FROM ranked WHERE place <= 25")
_reg("g5_2_vendor_risk_profile",  # lines first counted per vendor and order, which has one score
     ", per_order AS (SELECT vendor, orderkey, count(*) AS r FROM vendor_lines WHERE named GROUP BY vendor, orderkey), "
     "weighted AS (SELECT vendor, r, cvss_base_score AS s FROM per_order JOIN core_raw USING (orderkey) WHERE cvss_base_score IS NOT NULL), "
     "names AS (SELECT vendor, count(*) AS products FROM (SELECT DISTINCT vendor, product FROM vendor_lines "
     "JOIN core_raw USING (orderkey) WHERE named AND cvss_base_score IS NOT NULL) GROUP BY vendor), "
     f"profile AS (SELECT vendor, count(*) AS n, round(sum(s * r) / sum(r), {D}) AS a, max(s) AS hi, "
     "CAST(coalesce(sum(r) FILTER (WHERE s >= 9), 0) AS BIGINT) AS c, "
     "CAST(coalesce(sum(r) FILTER (WHERE s >= 7 AND s < 9), 0) AS BIGINT) AS h, "
     "CAST(coalesce(sum(r) FILTER (WHERE s >= 4 AND s < 7), 0) AS BIGINT) AS m FROM weighted GROUP BY vendor) "
     "SELECT vendor AS vendor_name, n AS total_cves, a AS avg_cvss_score, hi AS max_cvss_score, c AS critical_vulns, "
     "h AS high_vulns, m AS medium_vulns, products AS products_affected FROM profile JOIN names USING (vendor) "
     "ORDER BY n DESC, vendor LIMIT 20")
_reg("g6_1_batch_days", _batch_days("core_cves", "published_timestamp", "cve_id", "risk_category",
                                    ("CRITICAL", "HIGH"), "cvss_base_score", (20, 10, 5, 2)))
_reg("g6_1_batch_days_lines", _batch_days("lineitem", "l_shipdate", "l_orderkey", "l_returnflag", ("R", "A"), "l_quantity",
                                          (20, 10, 5, 2)), twin=False)
_reg("g6_2_org_activity",  # per nation key, where the customer is in credit; names are joined to the totals
     ", per_nation AS (SELECT o.c_nationkey AS nk, count(*) AS n, count(c.cvss_base_score) AS scored, sum(c.cvss_base_score) AS total, "
     "min(o.pub) AS f, max(o.pub) AS l FROM ord o JOIN core_raw c ON c.orderkey = o.o_orderkey WHERE o.c_acctbal >= 0 GROUP BY o.c_nationkey) "
     "SELECT n_name AS assigning_org_name, n AS total_assigned, n AS unique_cves, "
     f"round(total / scored, {D}) AS avg_cvss, f AS first_assignment, l AS last_assignment, "
     "CAST(date_diff('day', CAST(f AS DATE), CAST(l AS DATE)) AS INTEGER) AS activity_span_days "
     "FROM per_nation JOIN nation ON n_nationkey = nk ORDER BY n DESC, n_name LIMIT 20")
_reg("g7_1_cumulative_series", _cumulative("core_cves", "published_timestamp", "cvss_base_score", AS_OF))
_reg("g7_2_recent_activity",
     f"SELECT CAST(published_timestamp AS DATE) AS date, COUNT(*) AS cve_count, "
     f"{count_if(eq('risk_category', 'CRITICAL'))} AS critical, "
     f"{count_if(eq('risk_category', 'HIGH'))} AS high, "
     f"{count_if(eq('risk_category', 'MEDIUM'))} AS medium, "
     f"{avg('cvss_base_score')} AS avg_cvss FROM core_cves "
     f"WHERE published_timestamp >= CAST({AS_OF} - INTERVAL 30 DAY AS TIMESTAMP) GROUP BY 1")
_reg("g8_1_key_coverage",
     ", a_keys AS (SELECT cve_id FROM line_items WHERE vendor IS NOT NULL UNION SELECT cve_id FROM strays), "
     "c_keys AS (SELECT DISTINCT o_orderkey FROM orders) "
     "SELECT 'Referential Integrity' AS check_type, (SELECT count(*) FROM a_keys) AS cves_in_affected_products, "
     "(SELECT count(*) FROM c_keys) AS cves_in_core_table, (SELECT count(*) FROM a_keys) - (SELECT count(*) FROM c_keys) AS difference")
ORACLES["g8_1_key_coverage_join"] = ORACLES["g8_1_key_coverage"]
_reg("g8_2_orphan_count",  # every stray, and nothing else, lacks a record
     "SELECT 'Orphaned Products Check' AS validation_check, count(*) AS orphaned_count FROM lineitem "
     "JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal >= 0 AND s_name LIKE '%7' "
     "AND l_orderkey IN (SELECT o_orderkey FROM orders)", twin=False)
_reg("g8_3_duplicate_keys",
     ", per_key AS (SELECT cve_id, count(*) AS occurrence_count FROM revised_core GROUP BY cve_id) "
     "SELECT cve_id, occurrence_count FROM per_key WHERE occurrence_count > 1")
_reg("g9_1_kpi_summary", _kpi("risk_category", False))

# ---- exploratory variants ------------------------------------------------------------------------
_reg("e1_2_completeness_avg", _completeness(True))
_reg("e1_3_category_share_nonnull", _category_share("assigning_org_name", "WHERE assigning_org_name IS NOT NULL"))
_reg("e2_1_daily_trend_rating", _daily_trend("core_cves", "published_timestamp", "cve_id", "cvss_severity_rating",
                                             ("CRITICAL", "HIGH", "MEDIUM"), "cvss_base_score", 60))
_reg("e2_2_monthly_rollup_min", _monthly(True))
_reg("e3_1_rating_profile", _band_profile("cvss_severity_rating", "WHERE cvss_severity_rating IS NOT NULL"))
_reg("e3_2_version_usage_rating",
     _version_usage("cvss_severity_rating", ("CRITICAL", "HIGH"), "WHERE cvss_version_used IS NOT NULL"))
_reg("e3_4_top_records_assigner", _top_records(True, "severity_rating"))
_reg("e4_1_vendor_leaderboard_guarded", _vendor_leaderboard("known_product", "TRUE", 200))
_reg("e4_3_portfolio_risk", _portfolio((100, 50)))
_reg("e4_3_portfolio_risk_by_year", _portfolio((100, 50), "vendor_name || '/' || substring(cve_id, 5, 4)", 200))
_reg("e5_1_kpi_summary_rating", _kpi("cvss_severity_rating", True))

# ---- second binding: the events table ------------------------------------------------------------
_reg("g2_1_daily_trend_events",
     _daily_trend("events", "ts", "event_id", "event_type", ("purchase", "error", "signup"), None, None), twin=False)
_reg("g2_3_weekday_pattern_events", "WITH x AS (SELECT 1)" + _weekday("events", "ts", "value"), twin=False)
_reg("g6_1_batch_days_events", _batch_days("events", "ts", "event_id", "event_type", ("purchase", "error"), "value",
                                           (350, 333, 300, 2)), twin=False)
_reg("g7_1_cumulative_series_events", "WITH x AS (SELECT 1)" + _cumulative("events", "ts", "value", EVENTS_AS_OF),
     twin=False)

# ---- along time, upsert, stateful stream ---------------------------------------------------------
_SHIPMENTS = """, shipments AS (
  SELECT l_orderkey, l_linenumber, l_quantity, 'org-' || CAST(s_nationkey AS VARCHAR) AS org, l_shipdate + to_seconds(l_orderkey % 86400) AS ship_time
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
_reg("u1_upsert_core", """, deliveries AS (
  SELECT cve_id, cve_description, updated_timestamp, assigning_org_name, data_year FROM core_cves
  UNION ALL SELECT cve_id, cve_description || ' (revised)', updated_timestamp + INTERVAL 1 DAY, assigning_org_name, data_year
  FROM core_cves WHERE cve_description LIKE '%1-URGENT'
  UNION ALL SELECT cve_id, cve_description || ' (stale)', updated_timestamp - INTERVAL 1 DAY, assigning_org_name, data_year
  FROM core_cves WHERE cve_description LIKE '%1-URGENT')
SELECT * FROM deliveries QUALIFY row_number() OVER (PARTITION BY cve_id ORDER BY updated_timestamp DESC NULLS LAST) = 1""")
_reg("j1_asof_score", _SHIPMENTS + """, scores AS (
  SELECT assigning_org_id AS org, published_timestamp AS score_time, max(cvss_base_score) AS score_in_force
  FROM core_cves WHERE cvss_base_score IS NOT NULL AND published_timestamp IS NOT NULL GROUP BY ALL)
SELECT l_orderkey, l_linenumber, ship_time, score_time, score_in_force
FROM shipments l ASOF LEFT JOIN scores s ON l.org = s.org AND l.ship_time >= s.score_time""")
_reg("j2_interval_shipments", _SHIPMENTS + """
SELECT cve_id, count(*) AS n_lines, sum(l_quantity) AS quantity, min(ship_time) AS first_shipped
FROM core_cves JOIN shipments ON org = assigning_org_id AND ship_time BETWEEN published_timestamp AND updated_timestamp GROUP BY cve_id""")
_reg("w1_assigner_sessions", """, paused AS (
  SELECT assigning_org_id, published_timestamp AS t, CAST(has_cvss AS BIGINT) AS scored,
    published_timestamp <= lag(published_timestamp) OVER (PARTITION BY assigning_org_id ORDER BY published_timestamp) + INTERVAL 2 DAY AS goes_on
  FROM core_cves WHERE published_timestamp IS NOT NULL),
islands AS (
  SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY assigning_org_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM paused)
SELECT assigning_org_id, min(t) AS session_start, max(t) AS session_last, max(t) + INTERVAL 2 DAY AS session_end, count(*) AS n_rows,
  CAST(sum(scored) AS BIGINT) AS sum_scored
FROM islands GROUP BY assigning_org_id, island""")
_reg("st1_tumbling_counts", """
SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, event_type,
  count(*) AS n_rows, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS sum_cents
FROM events GROUP BY ALL""", twin=False)

# ---- groupings, frames, snapshots ----------------------------------------------------------------
_reg("a1_monthly_distinct", """
SELECT strftime(l_shipdate, '%Y-%m') AS month, count(DISTINCT l_partkey) AS parts, count(*) AS n_rows, TRUE AS within_error FROM lineitem GROUP BY 1""", twin=False)
_reg("a2_price_percentiles", """
WITH shares AS (SELECT unnest([0.0, 0.25, 0.5, 0.9, 0.99, 1.0])::DOUBLE AS share),
ranked AS (SELECT l_returnflag, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS r,
  count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem WHERE l_extendedprice IS NOT NULL)
SELECT l_returnflag, share, l_extendedprice AS value, n FROM ranked, shares WHERE r = greatest(1, n - CAST(floor(n - share * n) AS BIGINT))""", twin=False)
_reg("a3_grouping_sets", """
SELECT data_year, risk_category, assigning_org_name,
  CAST(GROUPING(data_year) + 2 * GROUPING(risk_category) + 4 * GROUPING(assigning_org_name) AS INTEGER) AS set_id,
  count(*) AS n_records, count(cvss_base_score) AS n_scored, max(cvss_base_score) AS max_score
FROM core_cves GROUP BY GROUPING SETS ((data_year, risk_category, assigning_org_name), (data_year, risk_category), (assigning_org_name), ())""")
_reg("a4_top_records_per_vendor", """
SELECT vendor_name, cve_id, cvss_base_score, CAST(row_number() OVER (PARTITION BY vendor_name ORDER BY cvss_base_score DESC, cve_id) AS INTEGER) AS rank
FROM (SELECT DISTINCT vendor_name, cve_id FROM affected_products) JOIN core_cves USING (cve_id) WHERE cvss_base_score IS NOT NULL QUALIFY rank <= 3""")
_reg("w2_moving_average", f""", days AS (
  SELECT CAST(published_timestamp AS DATE) AS day, assigning_org_id, count(*) AS n_rows FROM core_cves WHERE published_timestamp IS NOT NULL GROUP BY ALL)
SELECT day, assigning_org_id, n_rows, CAST(sum(n_rows) OVER month AS BIGINT) AS rows_in_range, count(*) OVER month AS active_days,
  round(sum(n_rows) OVER month / 30.0, {D}) AS rows_per_day,
  CAST(date_diff('day', lag(day) OVER org, day) AS INTEGER) AS days_since, CAST(date_diff('day', day, lead(day) OVER org) AS INTEGER) AS days_until,
  n_rows - lag(n_rows) OVER org AS change
FROM days WINDOW org AS (PARTITION BY assigning_org_id ORDER BY day),
  month AS (PARTITION BY assigning_org_id ORDER BY day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""")
_reg("d1_snapshot_diff", """, before AS (
  SELECT cve_id, cve_description, updated_timestamp, cvss_base_score, assigning_org_name FROM core_cves WHERE assigning_org_name IS NOT NULL),
after AS (
  SELECT cve_id, cve_description, updated_timestamp, cvss_base_score, assigning_org_name FROM revised_core WHERE risk_category <> 'LOW'),
differs AS (SELECT DISTINCT cve_id FROM ((SELECT * FROM before EXCEPT ALL SELECT * FROM after) UNION ALL (SELECT * FROM after EXCEPT ALL SELECT * FROM before)))
SELECT cve_id, CASE WHEN b = 0 THEN 'added' WHEN a = 0 THEN 'removed' ELSE 'changed' END AS change, b AS rows_before, a AS rows_after
FROM (SELECT cve_id, (SELECT count(*) FROM before x WHERE x.cve_id = d.cve_id) AS b, (SELECT count(*) FROM after x WHERE x.cve_id = d.cve_id) AS a FROM differs d)""")

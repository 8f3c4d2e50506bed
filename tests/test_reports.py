"""Gold and quality reports on small hand-made tables: two-digit HALF_UP rounding, labels, variants."""

from __future__ import annotations

import datetime as dt

from vulnlake import operators as op

CORE_SCHEMA = ("cve_id string, publication_state string, assigning_org_name string, published_timestamp timestamp, "
               "cve_description string, cvss_base_score double, cvss_severity_rating string, cvss_version_used string, "
               "risk_category string, has_description boolean, has_cvss boolean")


def core_frame(spark, rows):
    return spark.createDataFrame(rows, CORE_SCHEMA)


def _r(i, score, band, ts=dt.datetime(2024, 3, 1, 10), state="PUBLISHED", rating="HIGH", org="acme"):
    return (f"CVE-2024-{i:04d}", state, org, ts, f"desc {i}", score, rating, "3.1", band, True, score is not None)


def test_average_rounds_half_up(spark):
    core = core_frame(spark, [_r(1, 4.4, "MEDIUM"), _r(2, 4.5, "MEDIUM"), _r(3, 4.5, "MEDIUM"), _r(4, 4.5, "MEDIUM")])
    row = op.band_profile(core).first()
    assert row.avg_cvss_in_category == 4.48 and float(row.percentage) == 100.0


def test_share_rounds_half_up(spark):
    rows = [_r(i, 5.0, "MEDIUM") for i in range(3999)] + [_r(5000, 9.5, "CRITICAL")]
    shares = {r.risk_category: float(r.percentage) for r in op.band_profile(core_frame(spark, rows)).collect()}
    assert shares["CRITICAL"] == 0.03 and shares["MEDIUM"] == 99.98


def test_summary_and_completeness(spark):
    core = core_frame(spark, [_r(1, 9.1, "CRITICAL", ts=dt.datetime(2024, 1, 1)),
                              _r(2, None, "UNSCORED", ts=dt.datetime(2024, 1, 31), state="REJECTED")])
    s = op.dataset_summary(core).first()
    assert (s.total_cve_records, s.coverage_days, s.published_cves, s.rejected_cves) == (2, 30, 1, 1)
    assert float(s.publish_rate_percent) == 50.0
    c = op.completeness(core, score="cvss_base_score").first()
    assert (c.cvss_scores_available, float(c.cvss_coverage_percent), c.overall_avg_cvss_score) == (1, 50.0, 9.1)


def test_category_share_null_group(spark):
    core = core_frame(spark, [_r(1, 5.0, "MEDIUM"), _r(2, 5.0, "MEDIUM", state=None)])
    assert op.category_share(core).count() == 2
    only = op.category_share(core, drop_null=True).collect()
    assert len(only) == 1 and float(only[0].percentage) == 100.0


def test_labels_and_thresholds(spark):
    days = [_r(i, 8.0, "HIGH", ts=dt.datetime(2024, 1, 1 + (i % 3))) for i in range(12)]
    out = {str(r.publication_date): (r.cves_published, r.batch_classification)
           for r in op.batch_days(core_frame(spark, days), bounds=(4, 3, 2, 1)).collect()}
    assert set(out.values()) == {(4, "MAJOR BATCH")}
    aff = spark.createDataFrame([(f"CVE-{i}", "v", f"p{i % 3}") for i in range(120)],
                                "cve_id string, vendor_name string, product_name string")
    r = op.portfolio_density(aff, risk_bounds=(100, 50)).first()
    assert (r.product_portfolio_size, r.total_vulnerabilities, r.vendor_risk_level) == (3, 120, "HIGH RISK")
    assert float(r.vulnerability_density) == 40.0
    pp = op.product_priority(aff).first()
    assert pp.priority_level == "CRITICAL PRIORITY"


def test_weekday_and_recent(spark):
    sunday = dt.datetime(2024, 3, 3, 12)
    core = core_frame(spark, [_r(1, 5.0, "MEDIUM", ts=sunday), _r(2, 9.0, "CRITICAL", ts=dt.datetime(2024, 1, 1))])
    w = {r.day_number: r.day_of_week for r in op.weekday_pattern(core).collect()}
    assert w == {1: "Sunday", 2: "Monday"}
    recent = op.recent_activity(core, as_of=dt.date(2024, 3, 10), days=30).collect()
    assert [(str(r.date), r.cve_count, r.medium) for r in recent] == [("2024-03-03", 1, 1)]
    cum = op.cumulative_series(core, as_of=dt.date(2024, 3, 10)).collect()
    assert [r.cumulative_total for r in cum] == [2, 1] and cum[0].days_ago == 7


def test_top_records_and_kpi(spark):
    core = core_frame(spark, [_r(i, float(i % 10), "LOW") for i in range(30)])
    top = op.top_records(core, n=3).collect()
    assert [r.cvss_base_score for r in top] == [9.0, 9.0, 9.0] and top[0].cve_id == "CVE-2024-0009"
    aff = spark.createDataFrame([("CVE-2024-0001", "v", "p"), ("CVE-2024-0001", "w", "p")],
                                "cve_id string, vendor_name string, product_name string")
    k = op.kpi_summary(core, aff).first()
    assert (k.total_unique_cves, k.total_vendors, k.total_products) == (30, 2, 1)
    assert op.kpi_summary(core, aff, report_time="now").first().report_generated_at is not None


def test_quality_checks(spark):
    aff = spark.createDataFrame([("a", "v"), ("a", None), ("b", "v"), ("z", "w")], "cve_id string, vendor_name string")
    core = spark.createDataFrame([("a",), ("b",)], "cve_id string")
    st = op.integrity_status(aff, core).first()
    assert (st.orphan_keys, st.status) == (1, "WARNING")
    assert op.integrity_status(core, core).first().status == "PASSED"
    ts = op.table_stats(aff, ["vendor_name"]).first()
    assert (ts.total_rows, ts.distinct_vendor_name) == (4, 3)  # NULL counts as a value
    er = op.expansion_ratio(core, aff).first()
    assert (er.input_records, er.output_rows, float(er.expansion_ratio)) == (2, 4, 2.0)
    assert float(op.expansion_ratio(core.limit(0), aff).first().expansion_ratio) == 0.0
    cov = op.coverage(aff, ["vendor_name"]).first()
    assert (cov.vendor_name_present, float(cov.vendor_name_percent)) == (3, 75.0)
    layers = {r.layer: r.records for r in op.layer_counts({"a": aff, "c": core}).collect()}
    assert layers == {"a": 4, "c": 2}
    kc = op.key_coverage(aff, core).first()
    assert (kc.cves_in_affected_products, kc.cves_in_core_table, kc.difference) == (3, 2, 1)
    assert op.key_coverage(aff, core, method="join").first().asDict() == kc.asDict()


def test_vendor_reports_fan_out(spark):
    core = core_frame(spark, [_r(1, 9.5, "CRITICAL"), _r(2, 7.0, "HIGH")])
    aff = spark.createDataFrame([("CVE-2024-0001", "v", "p1"), ("CVE-2024-0001", "v", "p2"), ("CVE-2024-0002", "v", "p1")],
                                "cve_id string, vendor_name string, product_name string")
    r = op.vendor_risk_profile(aff, core).first()
    # averages and level counts run over joined (record, product) rows, not distinct records
    assert (r.total_cves, r.critical_vulns, r.high_vulns, r.products_affected) == (2, 2, 1, 2)
    assert r.avg_cvss_score == round((9.5 + 9.5 + 7.0) / 3, 2)
    d = op.critical_detail(core, aff).collect()
    assert [(x.cve_id, x.affected_vendor_count, x.affected_product_count) for x in d] == [("CVE-2024-0001", 1, 2)]
    lone = core_frame(spark, [_r(7, 9.9, "CRITICAL")])
    assert op.critical_detail(lone, aff).first().affected_vendor_count == 0


def test_severity_share_counts_only_remaining_rows(spark):
    rows = [_r(1, 9.5, "CRITICAL", rating="CRITICAL"), _r(2, 7.0, "HIGH", rating="HIGH"),
            _r(3, None, "UNSCORED", rating="UNKNOWN"), _r(4, None, "UNSCORED", rating=None)]
    prof = {r.cvss_severity_rating: float(r.percentage) for r in op.severity_profile(core_frame(spark, rows)).collect()}
    assert prof == {"CRITICAL": 50.0, "HIGH": 50.0}  # UNKNOWN and NULL are outside the denominator


def test_product_placeholder_counts_as_a_product(spark):
    from vulnlake import schemas as S
    aff = spark.createDataFrame([("CVE-1", "v", None), ("CVE-2", "w", "p")],
                                "cve_id string, vendor_name string, product_name string")
    filled = op.fill_defaults(aff, S.AFFECTED_DEFAULTS)
    core = core_frame(spark, [_r(1, 5.0, "MEDIUM")])
    assert op.kpi_summary(core, filled).first().total_products == 2
    assert op.kpi_summary(core, aff).first().total_products == 1

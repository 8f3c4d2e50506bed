"""The reports that are planned differently from how they read (G5.1, G8.1, G8.2, G9.1) against brute force in
Python, on random tables with NULL keys, duplicate records and orphans, and on empty ones."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from vulnlake import operators as op

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

ids = st.sampled_from(["CVE-1", "CVE-2", "CVE-3", "CVE-4", None])
core_row = st.tuples(ids, st.sampled_from([9.1, 9.8, 7.5, None]), st.sampled_from(["d1", "d2"]),
                     st.sampled_from([dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), None]))
aff_row = st.tuples(ids, st.sampled_from(["v1", "v2", None]), st.sampled_from(["p1", "p2", "p3"]))


def _frames(spark, core_rows, aff_rows):
    records = [(c, s, "CRITICAL" if s is not None and s >= 9 else "HIGH" if s else "UNSCORED", d, t) for c, s, d, t in core_rows]
    core = spark.createDataFrame(
        records, "cve_id string, cvss_base_score double, risk_category string, cve_description string, published_timestamp timestamp")
    aff = spark.createDataFrame(aff_rows, "cve_id string, vendor_name string, product_name string")
    return records, core, aff


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@SETTINGS
@given(st.lists(core_row, max_size=12), st.lists(aff_row, max_size=20))
@example([], [])
@example([("CVE-1", 9.1, "d1", None)], [])
@example([], [("CVE-1", "v1", "p1")])
def test_planned_forms_equal_brute_force(spark, core_rows, aff_rows):
    records, core, aff = _frames(spark, core_rows, aff_rows)

    detail = []
    for cve, score, band, text, ts in set(records):
        if band == "CRITICAL":
            mine = [r for r in aff_rows if cve is not None and r[0] == cve]
            detail.append((cve, score, band, ts.date() if ts else None, len({v for _, v, _ in mine if v is not None}),
                           len({p for _, _, p in mine}), text[:80]))
    assert _rows(op.critical_detail(core, aff, n=1000)) == sorted(detail, key=repr)

    in_aff, in_core = {r[0] for r in aff_rows} - {None}, {r[0] for r in records} - {None}
    coverage = [("Referential Integrity", len(in_aff), len(in_core), len(in_aff) - len(in_core))]
    assert _rows(op.key_coverage(aff, core)) == coverage
    assert _rows(op.key_coverage(aff, core, method="join")) == coverage

    assert op.orphan_count(aff, core).first().orphaned_count == sum(r[0] not in in_core for r in aff_rows)

    scores = [r[1] for r in records if r[1] is not None]
    times = [r[4] for r in records if r[4] is not None]
    kpi = tuple(op.kpi_summary(core, aff).first())
    assert kpi[:4] == ("CVE Lakehouse Executive Summary", len(in_core), len({r[1] for r in aff_rows} - {None}), len({r[2] for r in aff_rows}))
    assert kpi[4] is None if not scores else abs(kpi[4] - sum(scores) / len(scores)) <= 0.005 + 1e-9
    assert kpi[5:] == (sum(r[2] == "CRITICAL" for r in records), sum(r[2] == "HIGH" for r in records), max(times, default=None))


def test_reports_on_empty_tables(spark):
    """Every report runs without rows: grouped ones are empty, totals are one row whose counts are 0 or NULL."""
    from vulnlake.plans import bindings as B
    from vulnlake.plans.medallion import gold_reports

    core, aff = B.core_twin(spark, SF_SMALL).limit(0), B.affected_twin(spark, SF_SMALL).limit(0)
    one_row = {"g1_1_dataset_summary", "g1_2_completeness", "g8_1_key_coverage", "g8_2_orphan_count", "g9_1_kpi_summary",
               "e1_2_completeness_avg", "e5_1_kpi_summary_rating", "q1_coverage", "q4_table_stats", "q5_integrity_status"}
    for name, report in gold_reports(core, aff, as_of=B.AS_OF).items():
        rows = report().collect()
        assert len(rows) == (name in one_row), name
        if name in ("g9_1_kpi_summary", "e5_1_kpi_summary_rating"):
            r = rows[0]
            assert (r.total_unique_cves, r.total_vendors, r.total_products, r.overall_avg_cvss, r.critical_cves,
                    r.high_risk_cves, r.most_recent_publication) == (0, 0, 0, None, 0, 0, None)
        if name == "g8_1_key_coverage":
            assert tuple(rows[0])[1:] == (0, 0, 0)
        if name == "g8_2_orphan_count":
            assert rows[0].orphaned_count == 0

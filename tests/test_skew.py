"""Hot keys: one record (and one vendor) holding a third of the affected rows. Results must equal brute force,
and a skewed sort-merge join must be split by AQE rather than run in one task."""

from __future__ import annotations

import contextlib
import io
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vulnlake import operators as op

N = 30000


@pytest.fixture(scope="module")
def skewed(spark):
    core_rows = [(f"CVE-{i:05d}", 9.5 if i % 3 == 0 else 5.0, "CRITICAL" if i % 3 == 0 else "MEDIUM", f"d{i}")
                 for i in range(300)]
    aff_rows = []
    for j in range(N):
        hot = j < N // 3  # a third of all rows belong to CVE-00000 and vendor "hot"
        cve = "CVE-00000" if hot else f"CVE-{j % 300:05d}"
        aff_rows.append((cve, "hot" if hot else f"v{j % 17}", f"p{j % 41}-{j}"))
    core = (spark.createDataFrame(core_rows, "cve_id string, cvss_base_score double, risk_category string, "
                                             "cve_description string")
                 .withColumn("published_timestamp", F.to_timestamp(F.lit("2024-01-01 00:00:00"))))
    # the same rows generated by a multi-task scan (AQE splits a skewed partition along map outputs)
    j = F.col("id")
    hot = j < N // 3
    aff = spark.range(0, N, numPartitions=8).select(
        F.when(hot, F.lit("CVE-00000")).otherwise(F.format_string("CVE-%05d", j % 300)).alias("cve_id"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("v"), (j % 17).cast("string"))).alias("vendor_name"),
        F.concat(F.lit("p"), (j % 41).cast("string"), F.lit("-"), j.cast("string")).alias("product_name"))
    return core, aff, core_rows, aff_rows


def test_reports_equal_brute_force_under_skew(spark, skewed):
    core, aff, core_rows, aff_rows = skewed
    score = {c: s for c, s, _, _ in core_rows}
    vendors, products = defaultdict(set), defaultdict(set)
    for c, v, p in aff_rows:
        vendors[c].add(v)
        products[c].add(p)
    got = {r.cve_id: (r.affected_vendor_count, r.affected_product_count)
           for r in op.critical_detail(core, aff, n=1000).collect()}
    want = {c: (len(vendors[c]), len(products[c])) for c, _, band, _ in core_rows if band == "CRITICAL"}
    assert got == want
    prof = {r.vendor_name: r for r in op.vendor_risk_profile(aff, core, n=100).collect()}
    hot_scores = [score[c] for c, v, _ in aff_rows if v == "hot"]
    assert prof["hot"].critical_vulns == sum(1 for s in hot_scores if s >= 9)
    assert prof["hot"].total_cves == 1
    kc = op.key_coverage(aff, core).first()
    assert (kc.cves_in_affected_products, kc.cves_in_core_table) == (300, 300)


@contextlib.contextmanager
def small_skewed_partitions(spark):
    """No broadcasts, and partitions of a kilobyte count as skewed."""
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    previous = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in previous.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    assert "isFinalPlan=true" in text
    return text.split("== Initial Plan ==")[0]


def test_skewed_join_is_split(spark, skewed):
    core, aff, _, _ = skewed
    with small_skewed_partitions(spark):
        df = op.orphan_rows(aff, core)
        assert df.collect() == []  # executes this DataFrame's own plan, so explain() shows the final one
        assert "skew=true" in final_plan(df)


def test_critical_detail_splits_a_hot_record(spark, skewed):
    core, aff, core_rows, aff_rows = skewed
    with small_skewed_partitions(spark):
        df = op.critical_detail(core, aff, n=1000)
        got = {r.cve_id: (r.affected_vendor_count, r.affected_product_count) for r in df.collect()}
        text = final_plan(df)
    hot = [r for r in aff_rows if r[0] == "CVE-00000"]
    assert got["CVE-00000"] == (len({v for _, v, _ in hot}), len({p for _, _, p in hot}))
    assert "skew=true" in text and "BroadcastHashJoin" not in text


def test_key_coverage_of_a_hot_key_without_broadcasts(spark, skewed):
    core, aff, _, _ = skewed
    with small_skewed_partitions(spark):
        for method in ("union", "join"):
            r = op.key_coverage(aff, core, method=method).first()
            assert (r.cves_in_affected_products, r.cves_in_core_table, r.difference) == (300, 300, 0)

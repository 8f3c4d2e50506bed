"""Property tests: random documents and tables against brute-force formulations."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import bronze_of, cvss, doc
from vulnlake import operators as op
from vulnlake import schemas as S

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

severities = st.sampled_from(["CRITICAL", "HIGH", "MEDIUM", "LOW", "NONE", None])
scores = st.one_of(st.none(), st.integers(0, 100).map(lambda x: x / 10))
entry = st.one_of(
    st.builds(lambda s, v: {"cvssV3_1": cvss(s, v, f"CVSS:3.1/{v}")}, scores, severities),
    st.builds(lambda s, v: {"cvssV3_0": cvss(s, v, f"CVSS:3.0/{v}")}, scores, severities),
    st.just({"other": {"type": "ssvc"}}),
)
langs = st.sampled_from(["en", "es", "en-US", "fr"])
desc = st.builds(lambda lang, v: {"lang": lang, "value": v}, langs, st.one_of(st.none(), st.text("abc", max_size=3)))


def _brute_core(bronze):
    """The explode + groupBy formulation (per-entry rows, then aggregate) as an independent check."""
    md = F.from_json("cveMetadata", S.META_SCHEMA)
    d = bronze.select(md["cveId"].alias("cve_id"),
                      F.get_json_object("containers", "$.cna.metrics").alias("m"),
                      F.get_json_object("containers", "$.cna.descriptions").alias("d"))
    m = d.select("cve_id", F.explode_outer(F.from_json("m", S.metrics_schema())).alias("e"))
    agg = m.groupBy("cve_id").agg(*[F.max(F.col("e")[c][f]).alias(f"{c}_{f}")
                                   for c in ("cvssV3_1", "cvssV3_0") for f in ("baseScore", "baseSeverity")])
    p = d.select("cve_id", F.posexplode_outer(F.from_json("d", S.DESCRIPTION_SCHEMA)).alias("pos", "x"))
    first = (p.filter((F.col("x.lang") == "en") & F.col("x.value").isNotNull())
              .groupBy("cve_id").agg(F.min_by("x.value", "pos").alias("desc")))
    return {r.cve_id: r for r in agg.join(first, "cve_id", "left").collect()}


@SETTINGS
@given(st.lists(st.tuples(st.lists(entry, max_size=5), st.lists(desc, max_size=3)), min_size=1, max_size=6))
def test_higher_order_functions_equal_explode_group(spark, docs):
    texts = [doc(cve=f"CVE-2024-{i:04d}", metrics=m, descriptions=ds) for i, (m, ds) in enumerate(docs)]
    br = bronze_of(spark, texts)
    got = {r.cve_id: r for r in op.build_core(br).collect()}
    want = _brute_core(br)
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        score = w.cvssV3_1_baseScore if w.cvssV3_1_baseScore is not None else w.cvssV3_0_baseScore
        sev = w.cvssV3_1_baseSeverity if w.cvssV3_1_baseSeverity is not None else w.cvssV3_0_baseSeverity
        assert g.cvss_base_score == score
        assert g.cvss_severity_rating == (sev if sev is not None else "UNKNOWN")
        assert g.cve_description == (w.desc if w.desc is not None else "[No description provided]")


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["CRITICAL", "HIGH", "MEDIUM", "LOW", "UNSCORED"]), st.integers(0, 40)),
                min_size=1, max_size=40))
def test_shares_sum_to_hundred_and_running_total_ends_at_total(spark, rows):
    data = [(f"id{i}", band, dt.datetime(2024, 1, 1) + dt.timedelta(days=day), float(i % 10))
            for i, (band, day) in enumerate(rows)]
    core = spark.createDataFrame(data, "cve_id string, risk_category string, published_timestamp timestamp, "
                                       "cvss_base_score double")
    prof = op.band_profile(core).collect()
    assert abs(sum(float(r.percentage) for r in prof) - 100.0) <= 0.005 * len(prof) + 1e-9
    assert sum(r.cve_count for r in prof) == len(rows)
    series = op.cumulative_series(core, as_of=dt.date(2024, 3, 1)).collect()
    assert series[0].cumulative_total == len(rows)


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c", "d", None]), max_size=30),
       st.lists(st.sampled_from(["a", "b", "x"]), max_size=10))
def test_orphans_plus_matched_is_all(spark, child_keys, parent_keys):
    child = spark.createDataFrame([(k,) for k in child_keys], "cve_id string")
    parent = spark.createDataFrame([(k,) for k in parent_keys], "cve_id string")
    orphans = op.orphan_count(child, parent).first().orphaned_count
    matched = child.join(parent.select("cve_id").distinct(), "cve_id", "left_semi").count()
    assert orphans + matched == len(child_keys)
    assert orphans == sum(1 for k in child_keys if k is None or k not in set(parent_keys))

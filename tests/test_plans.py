"""Physical-plan checks: no Python in the hot path, no cartesian products, one shuffle for the core table,
bounded top-k, filters pushed into the scan, no joins where an aggregate suffices."""

from __future__ import annotations

import contextlib
import io
import os
import re

import pytest

from conftest import SF_SMALL, bronze_of, doc
from vulnlake import operators as op
from vulnlake.plans import bindings as B

# queries that write and read back when they are built: files, key discovery, tables, streams, dealt-out tables
EAGER = ("s01", "s02", "s04", "s05", "u1", "st1", "j1", "j2", "a1", "a2")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Arguments: (hashpartitioning\([^\n]*)", text)


@pytest.fixture(scope="module")
def silver_paths(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("silver"))
    core, aff = os.path.join(root, "core"), os.path.join(root, "aff")
    B.core_twin(spark, SF_SMALL).write.parquet(core)
    B.affected_twin(spark, SF_SMALL).write.parquet(aff)
    return core, aff


def test_build_core_has_exactly_one_shuffle(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bronze")
    bronze_of(spark, [doc(cve=f"CVE-2024-{i:04d}") for i in range(4)]).write.parquet(path)
    text = plan(op.build_core(spark.read.parquet(path)))
    ex = exchanges(text)
    assert len(ex) == 1 and "cve_description" in ex[0]
    assert not any(f in text for f in FORBIDDEN)
    aff_text = plan(op.build_affected(spark.read.parquet(path)))
    assert not exchanges(aff_text) and "Generate" in aff_text


def test_catalog_has_no_cartesian_or_python(spark):
    from vulnlake.plans.catalog import QUERIES
    for name, fn in QUERIES.items():
        if name.startswith(("s01", "u1", "st1")):  # their results are plain scans of what they wrote; their operators have plan tests
            continue
        text = plan(fn(spark, SF_SMALL))
        bad = [f for f in FORBIDDEN if f in text]
        assert not bad, (name, bad)


def test_top_k_is_bounded(spark, silver_paths):
    core = spark.read.parquet(silver_paths[0])
    assert "TakeOrderedAndProject" in plan(op.top_records(core))
    assert "TakeOrderedAndProject" in plan(op.org_activity(core))


def test_time_filter_and_columns_reach_the_scan(spark, silver_paths):
    core = spark.read.parquet(silver_paths[0])
    text = plan(op.recent_activity(core, as_of=B.AS_OF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(published_timestamp", text)
    read_schema = re.search(r"ReadSchema: (struct<[^\n]*>)", text).group(1)
    assert "cve_description" not in read_schema and "published_timestamp" in read_schema


def test_no_join_where_aggregates_suffice(spark, silver_paths):
    core, aff = (spark.read.parquet(p) for p in silver_paths)
    for df in (op.key_coverage(aff, core), op.kpi_summary(core, aff), op.expansion_ratio(core, aff)):
        assert "Join" not in plan(df)


def test_fan_out_is_aggregated_before_the_join(spark, silver_paths):
    core, aff = (spark.read.parquet(p) for p in silver_paths)
    text = plan(op.critical_detail(core, aff))
    # distinct (id, kind, name) pairs come before the counts: a hot id spreads over tasks
    assert any("cve_id" in e and "kind" in e and "name" in e for e in exchanges(text))
    assert "LeftOuter" in text and "LeftSemi" in text and not any(f in text for f in FORBIDDEN)


def test_key_coverage_joins_distinct_keys(spark, silver_paths):
    core, aff = (spark.read.parquet(p) for p in silver_paths)
    text = plan(op.key_coverage(aff, core, method="join"))
    assert "FullOuter" in text and text.count("HashAggregate") >= 4  # both sides are distinct before the join


def test_documents_are_parsed_once(spark, tmp_dir):
    """One parse of each text: cveMetadata, containers and the two arrays inside it; one for the affected list."""
    path = os.path.join(tmp_dir, "bronze")
    bronze_of(spark, [doc(cve=f"CVE-2024-{i:04d}") for i in range(4)]).write.parquet(path)
    bronze = spark.read.parquet(path)

    def physical(df):
        return df._jdf.queryExecution().executedPlan().toString()

    core = physical(op.build_core(bronze))
    assert core.count("from_json(") == 4
    affected = physical(op.build_affected(bronze))
    assert affected.count("from_json(") == 1 and affected.count("$.cna.affected") == 1
    docs = spark.read.text(path)
    from vulnlake.sources import split_documents, to_bronze_columns
    assert physical(to_bronze_columns(docs, keys=B.DOC_KEYS)).count("from_json(") == 1
    for frame in split_documents(docs.select("value", "_metadata"), "file", keys=B.DOC_KEYS):
        assert physical(frame).count("from_json(") == 1


def test_building_a_query_runs_no_job(spark, silver_paths):
    """Operators and reports are plans; only sources that write and read back act when built."""
    from vulnlake.plans.catalog import QUERIES
    from vulnlake.plans.medallion import gold_reports

    core, aff = (spark.read.parquet(p) for p in silver_paths)
    spark.sparkContext.setJobGroup("built", "building only")
    try:
        for make in gold_reports(core, aff, as_of=B.AS_OF).values():
            make()
        for name, fn in QUERIES.items():
            if not name.startswith(EAGER):
                fn(spark, SF_SMALL)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("built")
        # reading a parquet footer is a job of the reader, not of the query
        assert len(jobs) == 0 or all(_is_listing(spark, j) for j in jobs)
    finally:
        spark.sparkContext.setJobGroup("", "")


def _is_listing(spark, job) -> bool:
    info = spark.sparkContext.statusTracker().getJobInfo(job)
    stages = [spark.sparkContext.statusTracker().getStageInfo(s) for s in info.stageIds]
    return all(s is None or (s.numTasks == 1 and s.name.startswith("parquet at")) for s in stages)

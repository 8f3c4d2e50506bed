"""The batch flow end to end (documents folder -> bronze -> silver -> reports), and bucketed silver tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_plans import exchanges, plan
from vulnlake import operators as op
from vulnlake.plans import bindings as B
from vulnlake.plans.medallion import Layout, build_silver, gold_reports, ingest_bronze, silver_tables


def test_flow_matches_the_relational_twin(spark, tmp_dir):
    src = os.path.join(tmp_dir, "docs")
    B.documents(spark, SF_SMALL).write.partitionBy("doc_year").text(src)
    layout = Layout(bronze=os.path.join(tmp_dir, "bronze"), core=os.path.join(tmp_dir, "core"),
                    affected=os.path.join(tmp_dir, "aff"), rejected=os.path.join(tmp_dir, "rejected"))
    counts = ingest_bronze(spark, src, layout, doc_layout="lines", ingested_at=B.INGESTED_AT)
    assert counts == {"documents": 1500, "rejected": 0}
    bronze = spark.read.parquet(layout.bronze)
    assert set(bronze.columns) >= {"cveMetadata", "containers", "dataType", "_source_year", "_record_id"}
    assert spark.read.parquet(layout.rejected).count() == 0
    build_silver(spark, layout, at=B.INGESTED_AT)
    core, aff = silver_tables(spark, layout)
    cols = [c for c in core.columns if c != "silver_transform_timestamp"]
    twin = B.core_twin(spark, SF_SMALL).select(cols)
    assert core.select(cols).exceptAll(twin).count() == 0 and twin.exceptAll(core.select(cols)).count() == 0
    assert aff.count() == B.affected_twin(spark, SF_SMALL).count()
    import glob

    import pyarrow.parquet as pq
    some_file = glob.glob(f"{layout.core}/*.parquet")[0]
    assert pq.ParquetFile(some_file).metadata.row_group(0).column(0).compression == "ZSTD"
    reports = gold_reports(core, aff, as_of=B.AS_OF)
    assert reports["g9_1_kpi_summary"]().first().total_unique_cves == core.count()
    assert reports["g8_2_orphan_count"]().first().orphaned_count == 0
    assert reports["q5_integrity_status"]().first().status == "PASSED"


def test_bucketed_silver_joins_without_exchange(spark):
    core, aff = B.core_twin(spark, SF_SMALL), B.affected_twin(spark, SF_SMALL)
    layout = Layout(bronze="", core="vulnlake_test.core_cves", affected="vulnlake_test.affected_products", buckets=8)
    from vulnlake.sources import write_table
    write_table(core, layout.core, bucket_by=(8, "cve_id"))
    write_table(aff, layout.affected, bucket_by=(8, "cve_id"))
    core_t, aff_t = silver_tables(spark, layout)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = aff_t.join(core_t.select("cve_id", "cvss_base_score"), "cve_id")
        text = plan(joined)
        assert "SortMergeJoin" in text and not exchanges(text)
        assert op.orphan_count(aff_t, core_t).first().orphaned_count == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert core_t.filter(F.col("cve_id").isNotNull()).count() == core.count()


def test_ingest_counts_and_keeps_what_it_rejects(spark, tmp_dir):
    """Indented one-per-file documents; bronze, rejected table and counts agree with or without given keys."""
    from test_sources import make_tree

    make_tree(os.path.join(tmp_dir, "src"))
    for keys in (None, ["cveMetadata", "containers"]):
        root = os.path.join(tmp_dir, "all" if keys is None else "some")
        layout = Layout(bronze=f"{root}/bronze", core="", affected="", rejected=f"{root}/rejected")
        assert ingest_bronze(spark, os.path.join(tmp_dir, "src"), layout, year=2024, keys=keys) == {"documents": 3, "rejected": 2}
        bronze = spark.read.parquet(layout.bronze)
        ids = sorted(r[0] for r in bronze.select(F.get_json_object("cveMetadata", "$.cveId")).collect())
        assert ids == ["CVE-2024-0001", "CVE-2024-1002", "CVE-2024-1005"]
        assert ("dataType" in bronze.columns) == (keys is None)
        bad = {os.path.basename(r.source_file): r.value for r in spark.read.parquet(layout.rejected).collect()}
        assert sorted(bad) == ["CVE-2024-1003.json", "CVE-2024-1004.json"] and bad["CVE-2024-1004.json"].endswith("trailing garbage")


def test_given_keys_bronze_is_written_in_one_pass(spark, tmp_dir, monkeypatch):
    """No staged copy of the documents; a second scan only where something was rejected."""
    from test_sources import _write, indented, make_tree
    from conftest import doc
    from vulnlake.plans import medallion

    def no_staging(*_):
        raise AssertionError("documents were staged")

    monkeypatch.setattr(medallion, "scratch_path", no_staging)
    scans = []
    original = medallion.rejected_documents
    monkeypatch.setattr(medallion, "rejected_documents", lambda df: (scans.append("limit" not in df._jdf.queryExecution().logical().toString().lower()), original(df))[1])
    clean, mixed = os.path.join(tmp_dir, "clean"), os.path.join(tmp_dir, "mixed")
    _write(f"{clean}/CVE-2024-0001.json", indented(doc()))
    make_tree(mixed)
    _write(f"{mixed}/2024/CVE-2024-7777.json", "")
    for src, counts, second in ((clean, {"documents": 1, "rejected": 0}, False), (mixed, {"documents": 3, "rejected": 3}, True)):
        layout = Layout(bronze=f"{src}-bronze", core="", affected="", rejected=f"{src}-rejected")
        assert ingest_bronze(spark, src, layout, year=2024, keys=["cveMetadata", "containers"]) == counts
        assert scans.pop() == second and spark.read.parquet(layout.rejected).count() == counts["rejected"]
        assert ingest_bronze(spark, src, Layout(bronze=f"{src}-b2", core="", affected=""), year=2024, keys=["cveMetadata"]) == counts
    few = Layout(bronze=f"{tmp_dir}/few", core="", affected="")
    assert ingest_bronze(spark, mixed, few, year=2024, keys=["cveMetadata"], max_records=2) == {"documents": 2, "rejected": 3}
    os.makedirs(f"{tmp_dir}/none")
    nothing = Layout(bronze=f"{tmp_dir}/nb", core="", affected="", rejected=f"{tmp_dir}/nr")
    assert ingest_bronze(spark, f"{tmp_dir}/none", nothing, year=2024, keys=["cveMetadata"]) == {"documents": 0, "rejected": 0}


def test_command_line_flow(spark, tmp_dir, capsys):
    import glob

    from vulnlake.__main__ import main

    src = os.path.join(tmp_dir, "docs")
    B.documents(spark, SF_SMALL).write.partitionBy("doc_year").text(src)
    bronze, core, aff, out = (os.path.join(tmp_dir, x) for x in ("bronze", "core", "aff", "out"))
    assert main(["ingest", "--source", src, "--bronze", bronze, "--layout", "lines"]) == 0
    assert main(["silver", "--bronze", bronze, "--core", core, "--affected", aff]) == 0
    assert main(["report", "--core", core, "--affected", aff, "--name", "g3_1_band_profile",
                 "--name", "g9_1_kpi_summary", "--export", out, "--show", "5"]) == 0
    printed = capsys.readouterr().out
    assert "== g3_1_band_profile" in printed and "CRITICAL" in printed
    rows = spark.read.option("header", "true").csv(os.path.join(out, "g9_1_kpi_summary")).collect()
    assert len(rows) == 1 and int(rows[0].total_unique_cves) == 1500
    assert glob.glob(os.path.join(out, "g3_1_band_profile", "*.csv"))
    assert main(["report", "--core", core, "--affected", aff, "--name", "nope"]) == 2

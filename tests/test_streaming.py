"""Incremental ingestion: a second run over the same checkpoint picks up only new files."""

from __future__ import annotations

import os

from conftest import doc
from test_sources import _write, indented
from vulnlake import operators as op
from vulnlake.streaming import run_available, start_bronze_stream


def test_incremental_ingest_is_exactly_once(spark, tmp_dir):
    src, bronze, rejected, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "bronze", "rejected", "ckpt"))
    _write(f"{src}/2024/a/CVE-2024-0001.json", indented(doc(cve="CVE-2024-0001")))
    _write(f"{src}/2024/b/CVE-2024-0002.json", indented(doc(cve="CVE-2024-0002")))
    run_available(start_bronze_stream(spark, src, bronze, rejected, checkpoint_root=ckpt))
    assert spark.read.parquet(bronze).count() == 2

    _write(f"{src}/2024/c/CVE-2024-0003.json", indented(doc(cve="CVE-2024-0003", affected=[{"vendor": "v"}])))
    _write(f"{src}/2024/c/CVE-2024-0004.json", "{broken")
    run_available(start_bronze_stream(spark, src, bronze, rejected, checkpoint_root=ckpt))
    br = spark.read.parquet(bronze)
    assert br.count() == 3 and br.select("_record_id").distinct().count() == 3
    assert spark.read.parquet(rejected).count() == 1
    assert sorted(r.cve_id for r in op.build_core(br).collect()) == ["CVE-2024-0001", "CVE-2024-0002", "CVE-2024-0003"]
    assert op.build_affected(br).count() == 1
    assert {r._source_year for r in br.collect()} == {2024}


def test_two_streams_of_one_session_keep_apart_with_default_checkpoints(spark, tmp_dir):
    for turn in (1, 2):  # the second turn restarts both over one more file each
        for name in ("a", "b"):
            src, bronze = os.path.join(tmp_dir, name, "src"), os.path.join(tmp_dir, name, "bronze")
            _write(f"{src}/CVE-2024-000{turn}.json", indented(doc(cve=f"CVE-2024-{name}-{turn}")))
            run_available(start_bronze_stream(spark, src, bronze))
            ids = sorted(r.cve_id for r in op.build_core(spark.read.parquet(bronze)).collect())
            assert ids == [f"CVE-2024-{name}-{k}" for k in range(1, turn + 1)]

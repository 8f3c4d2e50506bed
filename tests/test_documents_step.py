"""The rendered documents: what their exchanges carry, how lines files are stored, how records are merged."""

from __future__ import annotations

import glob
import json
import os

from conftest import SF_SMALL, bronze_of, doc
from test_plans import plan
from vulnlake import operators as op
from vulnlake.plans import bindings as B
from vulnlake.plans import catalog
from vulnlake.plans.catalog import QUERIES
from vulnlake.session import shared_dir


def test_lines_are_dealt_before_they_are_rendered(spark):
    """Neither JSON parts nor collected lists go through an exchange: lines are dealt as they are."""
    text = B.documents(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    grouped = text.index("partial_collect_list(")
    dealt = text.index("hashpartitioning(l_orderkey")
    assert grouped < dealt  # the plan is printed from the top: the exchange lies below the grouping
    below = text[dealt:]
    assert "CVSS:" not in below and "collect_list" not in below and "affected" not in below


def test_lines_files_are_compressed(spark):
    def stored(label):
        return set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/{label}-*"))

    for name, label, folder in (("s01_scan_documents", "scan-documents", ""), ("s01_scan_limit", "scan-limit", ""), ("s01_scan_documents_stream", "stream-documents", "src")):
        before = stored(label)
        assert QUERIES[name](spark, SF_SMALL).count() > 0
        (root,) = stored(label) - before
        parts = glob.glob(os.path.join(root, folder, "**", "part-*"), recursive=True)
        assert parts and all(p.endswith(".gz") for p in parts)


def test_document_files_are_written_read_and_freed_in_parts(spark, monkeypatch):
    """Never more files than those of a part are there at once, every part is read, and none are left."""
    def files():
        return set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/document-files-*/**/*.json", recursive=True))

    def write(docs, root, real=B.write_document_files):
        real(docs, root)
        held.append(len(files() - before))

    monkeypatch.setattr(catalog, "ARCHIVE_PARTS", 3)
    monkeypatch.setattr(catalog, "ARCHIVE_DOCS", 1)
    monkeypatch.setattr(B, "write_document_files", write)
    held, before, want = [], files(), []
    for r in B.documents(spark, SF_SMALL).collect():
        meta = json.loads(r.value)["cveMetadata"]
        want.append((meta["cveId"], True, meta["state"]))
        if meta["cveId"].endswith("00"):
            want += [(f"{meta['cveId']}-{name}", False, why) for name, why in (
                ("cut", "syntax error"), ("more", "extra data whole"), ("empty", "empty file"), ("list", "not exactly one JSON object: list"))]
    assert sorted(map(tuple, QUERIES["s01_scan_documents_files"](spark, SF_SMALL).collect())) == sorted(want)
    assert len(held) == 3 and max(held) < 0.5 * sum(held) and sum(held) > len(want)  # ``notes`` are written, not read
    assert files() <= before


def test_documents_of_one_id_meet_in_one_part(spark, tmp_dir, monkeypatch):
    once = [(1992 + i % 3, doc(cve=f"CVE-{1992 + i % 3}-{i:07d}")) for i in range(40)]
    monkeypatch.setattr(B, "documents", lambda s, d: s.createDataFrame(once + once[:9] + [(1999, doc(cve="CVE-1999-0000007", state="x"))] * 2, "doc_year int, value string").repartition(7))
    parts = B.documents_in_parts(spark, SF_SMALL, 5)
    found = [(k, r.doc_year, json.loads(r.value)["cveMetadata"]["cveId"]) for k, (docs, _) in parts.items() for r in docs.collect()]
    assert len(found) == 51 and len({(k, i) for k, _, i in found}) == 41 and len(parts) > 1
    assert all(years == sorted({y for p, y, _ in found if p == k}) for k, (_, years) in parts.items())


def test_the_merge_sorts_by_a_hash_of_the_keys_first(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bronze")
    bronze_of(spark, [doc(cve=f"CVE-2024-{i:04d}") for i in range(4)] * 2).write.parquet(path)
    core = op.build_core(spark.read.parquet(path))
    assert "_keys_hash" in plan(core) and "_keys_hash" not in core.columns and core.count() == 4

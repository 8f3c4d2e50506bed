from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from vulnlake.session import build_session  # noqa: E402
from vulnlake.sources import to_bronze_columns, with_ingest_metadata  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
INGESTED = "2024-06-01 00:00:00"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="vulnlake-tests-")
    s = build_session("local[4]", app="vulnlake-tests", shuffle_partitions=4, extra={
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
    })
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="vulnlake-t-")


def doc(cve="CVE-2024-0001", state="PUBLISHED", published="2024-03-01T10:00:00.000Z", descriptions=None,
        metrics=None, affected=None, meta=None, extra_meta=None, **top) -> str:
    """A document in the advisory layout; ``None`` leaves a part out, ``meta`` overrides cveMetadata text."""
    md = {"cveId": cve, "state": state, "assignerOrgId": "org-1", "assignerShortName": "acme"}
    if published is not None:
        md["datePublished"] = published
    md.update(extra_meta or {})
    cna = {}
    if descriptions is not None:
        cna["descriptions"] = descriptions
    if metrics is not None:
        cna["metrics"] = metrics
    if affected is not None:
        cna["affected"] = affected
    body = {"dataType": "CVE_RECORD", "cveMetadata": md, "containers": {"cna": cna}, **top}
    text = json.dumps(body)
    if meta is not None:
        text = text.replace(json.dumps(md), meta)
    return text


def bronze_of(spark, docs, ingested_at=INGESTED, year=2024):
    frame = spark.createDataFrame([(d,) for d in docs], "value string")
    return with_ingest_metadata(to_bronze_columns(frame, keys=("cveMetadata", "containers")), year, ingested_at)


def cvss(score=None, severity=None, vector=None):
    out = {}
    if score is not None:
        out["baseScore"] = score
    if severity is not None:
        out["baseSeverity"] = severity
    if vector is not None:
        out["vectorString"] = vector
    return out

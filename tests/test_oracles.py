"""Every registered query against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck

import __spark_entry__ as E
from vulnlake.plans.catalog import QUERIES
from vulnlake.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, _, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert not problems, problems


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and rows[0].total_unique_cves > 0

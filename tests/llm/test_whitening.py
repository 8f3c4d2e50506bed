from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm_tools import table_rows
from vulnlake.llm import qd, whitening as W
from vulnlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SHAPE = "vec_id bigint, embedding array<float>, label int"


def truth(vectors):
    """Exact sums, and the covariance's eigenvectors by the library's symmetric solver."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    dev = n * x - s
    centred = dev.astype(float) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    return n, (dev * dev).sum(1), centred, values[::-1], directions[:, ::-1]


def check(rows, vectors, k):
    n, deviation, centred, values, directions = truth(list(vectors.values()))
    got = defaultdict(dict)
    for r in rows:
        got[r.vec_id][r.component] = r
    assert set(got) == set(vectors) and all(set(c) == set(range(1, k + 1)) for c in got.values())
    w = np.array([[got[i][c].whitened for c in range(1, k + 1)] for i in vectors])
    want = centred @ directions[:, :k] / np.sqrt(values[:k])
    for j in range(k):
        sign = 1 if w[:, j] @ want[:, j] > 0 else -1
        assert np.abs(w[:, j] - sign * want[:, j]).max() < 1e-8
    cov = np.cov(w.T, bias=True).reshape(k, k)
    for i, d in zip(vectors, deviation):
        for c, r in got[i].items():
            assert r.n == n and r.deviation == d and int(r.deviation_wide) == d
            assert abs(r.explained / (values[c - 1] / values.sum()) - 1) < 1e-9
            assert abs(r.identity_error - np.abs(cov - np.eye(k)).max()) < 1e-9 and r.identity_error < 1e-9


def test_query_equals_a_symmetric_solver(spark):
    vectors = dict(table_rows(SF, "embeddings", "vec_id, embedding"))
    check(QUERIES["op13_whitening"](spark, SF).collect(), vectors, 8)


def test_dropped_vectors_and_hot_copies(spark):
    rng = np.random.default_rng(1)
    vectors = {i: rng.standard_normal(5).tolist() if i % 3 else [0.5, -1.25, 3.0, 0.0, 1e-4] for i in range(60)}  # a third are copies
    bad = {100: None, 101: [1.0, None, 1.0, 1.0, 1.0], 102: [float("nan")] * 5, 103: [math.inf, 0.0, 0.0, 0.0, 0.0], 104: [3e38, 0.0, 0.0, 0.0, 0.0], 105: [1.0], 106: []}
    rows = [(i, v, 1) for i, v in {**vectors, **bad}.items()]
    df = spark.createDataFrame(rows, SHAPE).withColumns({c: F.lit("clash") for c in ("id", "x", "n", "w", "component", "deviation")})
    check(W.whiten(df).collect(), vectors, 5)


def test_many_blocks_and_levels(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors = {i: (rng.standard_normal(6) * [9, 5, 3, 2, 1, .5] + 40).tolist() for i in range(400)}
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors.items()], SHAPE).repartition(9)
    monkeypatch.setattr(W, "BLOCK", 16)
    monkeypatch.setattr(W, "GATHERED", 8 * 36 * 2)
    check(W.whiten(df, components=4).collect(), vectors, 4)


def test_flat_components_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0, 7.0], 0), (1, [2.0, 4.0, 7.0], 0), (1, [2.0, 4.0, 7.0], 0)], SHAPE)
    rows = W.whiten(df).collect()
    assert len(rows) == 9 and {r.component for r in rows if r.whitened is not None} == {1}
    assert all(r.identity_error < 1e-12 for r in rows) and sum(r.vec_id is None for r in rows) == 3
    one = W.whiten(spark.createDataFrame([(7, [1.0, 2.0], 0)], SHAPE)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, 0.0, None), (2, 1, 0, None, 0.0, None)]
    empty = W.whiten(spark.createDataFrame([], SHAPE))
    assert empty.count() == 0 and empty.columns == one[0].__fields__


def test_deviations_beyond_64_bits(spark):
    big = 2.0 ** 42
    rows = W.whiten(spark.createDataFrame([(0, [big, 0.0], 0), (1, [-big, 1.0], 0)], SHAPE)).collect()
    x = [[int(big) * 1024 + 100_000, 100_000], [-int(big) * 1024 + 100_000, 101_024]]
    s = [sum(c) for c in zip(*x)]
    want = {i: sum((2 * v - t) ** 2 for v, t in zip(x[i], s)) for i in (0, 1)}
    assert all(r.deviation is None and int(r.deviation_wide) == want[r.vec_id] for r in rows)


@pytest.mark.parametrize("name,matrix", [
    ("random", np.random.default_rng(3).standard_normal((90, 40))),
    ("one value", np.eye(12)),
    ("equal pairs", np.diag([3, 3, 3, 2, 2, 1.0, 1, 0, 0])),
    ("one direction", np.ones((30, 10))),
    ("graded", np.random.default_rng(4).standard_normal((90, 40)) * 10.0 ** -np.arange(0, 20, .5)),
    ("hidden groups", np.linalg.qr(np.random.default_rng(5).standard_normal((32, 32)))[0] * ([5.0] * 9 + [1.0] * 23) @ np.linalg.qr(
        np.random.default_rng(6).standard_normal((32, 32)))[0]),
    ("close values", np.linalg.qr(np.random.default_rng(7).standard_normal((32, 32)))[0] * (1 + 1e-9 * np.arange(32))),
])
def test_solver_against_the_library(name, matrix):
    r = np.linalg.qr(matrix, mode="r")
    values, v = qd.right_singular(r, 8)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-11
    assert np.abs(r.T @ (r @ v) - v * values[:v.shape[1]]).max() < 1e-12 * want[0]


def test_small_singular_values_keep_their_digits():
    a, b = 10.0 ** -np.arange(12.0), 0.5 * 10.0 ** -np.arange(1.0, 12.0)
    values = qd.dqds(a, b)
    assert abs(np.prod(np.sqrt(values)) / np.prod(a) - 1) < 1e-12  # the determinant, over 66 orders of magnitude

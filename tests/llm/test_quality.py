from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from tests_llm_tools import docs_of, table_rows  # noqa: F401
from vulnlake.llm import quality as q
from vulnlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_fold(spark):
    labels = dict(table_rows(SF, "labels", "doc_id, quality"))
    rows = QUERIES["op1_quality"](spark, SF).collect()
    assert len(rows) == len(table_rows(SF, "documents", "doc_id"))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    unseen = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(unseen) > 80 and np.mean([a == b for a, b in unseen]) >= 0.97


def test_nulls_empty_texts_copies_and_no_labels(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "plain words here. " * 9), (3, "plain words here. " * 9), (None, "x"), (4, "long " * 200_000)])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = q.classify(docs, none).collect()
    assert len(rows) == 6 and {r.score for r in rows} == {0.5} and all(r.held_out is False for r in rows if r.doc_id is None)
    learned = [i for i in range(10, 40) if zlib.crc32(str(i).encode()) % 3 != 1][:3]
    docs = docs.unionByName(docs_of([(i, "x") for i in learned]))
    one_sided = spark.createDataFrame([x for i in learned for x in ((i, 1, 0), (i, 0, 0))] + [(None, 0, 0), (4, None, 0)], none.schema)
    scores = {r.score for r in q.classify(docs, one_sided).collect()}
    assert len(scores) == 1 and scores.pop() > 0.99  # several labels of an id count as the larger: all are good
    assert q.classify(docs.limit(0), one_sided).count() == 0
    assert all(np.isfinite(q.statistics(t)).all() and len(q.statistics(t)) == len(q.FEATURES) for t in ("", " ", "\n\n", "é", "a" * 10_000))


def test_traversal_equals_walking_each_tree():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0.2) & (x[:, 1] < 0.5) | (x[:, 2] > 1)).astype(float)
    trees = q.fit(x, y, trees=12, depth=3, bins=16)
    for k in rng.choice(500, 40):
        total = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if x[k, feature[node]] > threshold[node] else 1)
            total += value[node - len(feature)]
        assert np.isclose(trees.raw(x[k:k + 1])[0], total)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.9


def test_the_sample_of_labels_is_bounded_and_whole_below_the_bound(spark):
    stats = spark.range(3000).select(F.col("id").alias("doc_id"), F.array(*[F.rand(k).cast("float") for k in range(len(q.FEATURES))]).alias("x"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    seen = []
    original = q.fit
    try:
        q.fit = lambda x, y, **o: seen.append(len(y)) or original(x, y, trees=1)
        q.fit_on_labels(stats, labels, rows=10_000)
        q.fit_on_labels(stats, labels, rows=400)
    finally:
        q.fit = original
    fold = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(3000))
    assert seen[0] == fold and 300 < seen[1] < 500


def test_rejected_documents_go(spark, docs_of):
    good = "The quiet river moved under the old stone bridge while people walked home. " * 4
    bad = "BUY!! NOW!! ### *** %%% $$$ " * 12
    docs = docs_of([(k, f"{bad if k % 2 else good}{k}") for k in range(60)] + [(None, good), (61, None)])
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(60)], "doc_id bigint, quality int")
    out = q.keep_good(docs, labels)
    assert out.columns == docs.columns
    ids = {r.doc_id for r in out.collect()}
    assert {k for k in range(60) if k % 2 == 0} | {None} <= ids and not ids & {k for k in range(60) if k % 2}


def brute_fit(x, y, trees, depth, rate, bins, least, ridge):
    """Newton boosting written out: every feature and edge of every node by plain sums."""
    base = np.log(y.mean() / (1 - y.mean()))
    edges = [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).tolist())) for j in range(x.shape[1])]
    raw, out = [base] * len(y), []
    for _ in range(trees):
        p = [1 / (1 + np.exp(-r)) for r in raw]
        g, h = [a - b for a, b in zip(y, p)], [max(b * (1 - b), 1e-6) for b in p]

        def grow(rows, level):
            if level == depth:
                return rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + ridge)
            score = lambda part: sum(g[i] for i in part) ** 2 / (sum(h[i] for i in part) + ridge)
            best = (0.0, None, None)
            for j, cuts in enumerate(edges):
                for cut in cuts:
                    left, right = [i for i in rows if x[i, j] <= cut], [i for i in rows if x[i, j] > cut]
                    if min(sum(h[i] for i in left), sum(h[i] for i in right)) < least / 4:
                        continue
                    gain = score(left) + score(right) - score(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, j, cut)
            if best[1] is None:
                return ("all", grow(rows, level + 1))
            return (best[1], best[2], grow([i for i in rows if x[i, best[1]] <= best[2]], level + 1),
                    grow([i for i in rows if x[i, best[1]] > best[2]], level + 1))

        def walk(node, i):
            while isinstance(node, tuple):
                node = node[1] if node[0] == "all" else node[2] if x[i, node[0]] <= node[1] else node[3]
            return node

        tree = grow(list(range(len(y))), 0)
        out.append(lambda i, tree=tree: walk(tree, i))
        raw = [r + walk(tree, i) for i, r in enumerate(raw)]
    return raw


def test_fit_equals_boosting_written_out():
    rng = np.random.default_rng(5)
    for seed in range(4):
        x = rng.normal(size=(90, 3)).round(2)
        y = ((x[:, 0] > 0.1) ^ (x[:, 1] * seed > 0.3)).astype(float)
        y[:9] = 1 - y[:9]
        options = dict(trees=4, depth=3, rate=0.3, bins=8, least=5.0, ridge=1.0)
        assert np.abs(q.fit(x, y, **options).raw(x) - brute_fit(x, y, **options)).max() < 1e-9


def test_a_repeated_id_does_not_fill_the_sample(spark, docs_of):
    """One id a thousand times over: its equal rows count once, its different ones are sampled like all others."""
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    stats = q.document_statistics(docs_of([(ids[0], "the same text")] * 1000 + [(i, f"text {i} " * i) for i in ids[1:]]))
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id bigint, quality int")
    seen = []
    original = q.fit
    try:
        q.fit = lambda x, y, **o: (seen.append(len(y)), original(x, y, **o))[1]
        q.fit_on_labels(stats, labels)
        many = q.document_statistics(docs_of([(ids[0], f"version {k} " * (k % 50 + 1)) for k in range(3000)]))
        q.fit_on_labels(many, labels, rows=100)
    finally:
        q.fit = original
    assert seen[0] == len(ids) and seen[1] <= 200

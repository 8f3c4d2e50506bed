from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_check import compare, duck
from tests_llm_tools import docs_of  # noqa: F401
from vulnlake.llm import lexical_search as L
from vulnlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def truth(docs, items, k):
    """Every document scored for every item; rows with equal ids and scores are told apart by nothing."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, words = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counted:
            m = 50 + (50 * n * n_docs) // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").withColumns({c: F.lit("clash") for c in ("query", "id", "rank", "part")})


def words_table(seed, n_docs, n_items):
    """Frequent and rare words, a third of the rows copies of one text, equal scores."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    text = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    hot = text(30)
    docs = [(i, hot if i % 3 == 0 else text(rng.choice([1, 5, 40, 200]))) for i in range(n_docs)]
    return docs, [(i, text(rng.choice([1, 3, 12]))) for i in range(n_items)]


def test_query_matches_its_oracle(spark):
    problems, n, _ = compare(spark, duck(SF), "op12", QUERIES["op12_lexical_search"], ORACLES["op12_lexical_search"], SF)
    assert not problems and n > 0


@pytest.mark.parametrize("seed", range(3))
def test_small_blocks_groups_and_levels(spark, docs_of, monkeypatch, seed):
    docs, items = words_table(seed, 300, 9)
    monkeypatch.setattr(L, "BLOCK_DOCS", 16)
    got = rows_of(L.search(docs_of(docs).repartition(3), items_of(spark, items), k=7, most_terms=15))
    assert got == truth(docs, items, 7)


def test_edge_rows(spark, docs_of):
    docs = [(5, "Alpha beta"), (2, "ALPHA,beta!"), (2, "alpha_beta"), (None, "alpha beta"), (9, None), (8, ""), (7, " -- "), (4, "É é 中文 x1"), (6, "gamma " * 5000)]
    items = [(1, "beta alpha alpha"), (1, "É"), (None, "gamma 中文"), (3, None), (4, "..."), (5, "nowhere")]
    assert rows_of(L.search(docs_of(docs), items_of(spark, items), k=3)) == truth(docs, items, 3)
    assert L.search(docs_of([]), items_of(spark, items)).count() == 0
    assert L.search(docs_of(docs), items_of(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_intervals_close_on_the_true_scores(seed):
    rng = np.random.default_rng(seed)
    size, n_terms, k = 400, 12, 5
    present = rng.random((size, n_terms)) < np.linspace(0.9, 0.01, n_terms)
    doc, term = np.nonzero(present)
    tf = rng.integers(1, 9, len(doc))
    stats = L.Statistics(size, 40 * size, np.floor(1000 * np.log((2 * size + 2) / (2 * present.sum(0) + 1))).astype(np.int64))
    block = L.Block(np.arange(size), rng.integers(10, 90, size), doc, term, tf, stats)
    true = defaultdict(int)
    for d, impact in zip(block.doc.tolist(), block.impact.tolist()):
        true[d] += impact
    places, scores = L.nra(block, np.arange(n_terms + 2), k)
    assert all(true[p] == s for p, s in zip(places.tolist(), scores.tolist()))
    want = sorted(true.values(), reverse=True)[:k]
    assert sorted(scores.tolist(), reverse=True)[:k] == want and min(scores) >= want[-1]
    bar = want[1]
    assert sorted(L.nra(block, np.arange(n_terms), k, bar)[1].tolist(), reverse=True) == [v for v in sorted(true.values(), reverse=True) if v >= bar]


def test_reading_stops_early():
    """With a clear winner the tail of a long list stays unread but for what closes the winner's interval."""
    size = 5000
    doc, term = np.concatenate([np.arange(size), [7]]), np.concatenate([np.zeros(size, int), [1]])
    tf = np.ones(size + 1, np.int64)
    stats = L.Statistics(size, 10 * size, np.array([10, 9000]))
    block = L.Block(np.arange(size), np.full(size, 10), doc, term, tf, stats)
    places, scores = L.nra(block, np.array([0, 1]), 1)
    assert places.tolist() == [7] and len(scores) == 1

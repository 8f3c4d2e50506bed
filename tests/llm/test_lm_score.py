from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from tests_llm_tools import docs_of, table_rows  # noqa: F401
from vulnlake.llm import lm_score as lm
from vulnlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
S, E = object(), object()


def brute_force(rows, targets):
    """Both models with dictionaries, straight from the definition."""
    texts = [(i, lm.TOKEN.findall(t or "")) for i, t in rows]

    def counted(kept):
        count = Counter()
        for t in kept:
            if t:
                s = [S, S, *t, E]
                count.update((w,) for w in s[1:])
                count.update(zip(s, s[1:]))
                count.update(zip(s, s[1:], s[2:]))
        return count

    background, target = counted([t for _, t in texts]), counted([t for i, t in texts if i in targets])
    words = len({g for g in background if len(g) == 1 and g != (S,)})

    def model(count):
        events = sum(c for g, c in count.items() if len(g) == 1 and g != (S,))

        def p(gram):
            if len(gram) == 1:
                return (count[gram] + 1) / (events + words)
            return (count[gram] + lm.K * p(gram[1:])) / (count[gram[:-1]] + lm.K)

        return p

    out = []
    for i, t in texts:
        s = [S, S, *t]
        b, g = (-sum(math.log2(p(tuple(s[k - 2:k + 1]))) for k in range(2, len(s))) / len(t) if t else None for p in (model(background), model(target)))
        out.append((i, len(t), g, b, b - g if t else 0.0))
    return out


def same(got, want):
    key = lambda r: (repr(r[0]), r[1], round(r[4], 6))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and all(x == pytest.approx(y, abs=1e-9) for x, y in zip(a[2:], b[2:])), (a, b)


def result(df):
    return [tuple(r) for r in df.select("doc_id", "n_tokens", "loss_target", "loss_background", "score").collect()]


@pytest.mark.parametrize("block, bucket, piece", [(lm.BLOCK, lm.PER_BUCKET, lm.PIECE), (20, 8, lm.PIECE), (30, 16, 4)])
def test_scores_equal_the_definition(spark, docs_of, monkeypatch, block, bucket, piece):
    monkeypatch.setattr(lm, "BLOCK", block)
    monkeypatch.setattr(lm, "PER_BUCKET", bucket)
    monkeypatch.setattr(lm, "PIECE", piece)
    lm._tables.cache_clear()
    rows = [(1, "the cat sat on the mat, the cat sat."), (2, "the dog sat"), (3, None), (4, " \n"), (5, "zzzz é ∑ 😀 你好 zz"), (5, "again the cat ran"),
            (None, "the cat"), (7, "a"), (8, "the cat sat on the mat"), (8, "the cat sat on the mat"), (9, "the bird the cow the cat the end"), (10, "x" * 70)]
    targets = spark.createDataFrame([(1,), (2,), (2,), (None,), (99,)], "doc_id bigint")
    same(result(lm.cross_entropy_difference(docs_of(rows).repartition(3), targets)), brute_force(rows, {1, 2}))
    lm._tables.cache_clear()


def test_hot_ngrams_and_large_counts(spark, docs_of):
    rows = [(i, "same words again " * 40 if i % 3 else f"own w{i}") for i in range(60)]
    targets = spark.createDataFrame([(k,) for k in (1, 2, 3)], "doc_id bigint")
    same(result(lm.cross_entropy_difference(docs_of(rows).repartition(4), targets)), brute_force(rows, {1, 2, 3}))


def test_without_targets_and_empty(spark, docs_of):
    none = spark.createDataFrame([], "doc_id bigint")
    rows = [(1, "abc abc d"), (2, "")]
    same(result(lm.cross_entropy_difference(docs_of(rows), none)), brute_force(rows, set()))
    assert lm.cross_entropy_difference(docs_of([]), none).count() == 0


@pytest.mark.parametrize("piece", [3, 64, lm.PIECE])
def test_hashes_tell_tokens_as_the_pattern_does(monkeypatch, piece):
    monkeypatch.setattr(lm, "PIECE", piece)
    lm._tables.cache_clear()
    texts = ["a b  a,b! a_b 1st", "你好 world。x", "ßÄé ÄÉ", " ", "", "x" * 200 + " " + "x" * 200 + " " + "x" * 199, "é,é;É", "ab a b", "١٢ ١٢ ๑"]
    known = {}
    for t in texts:
        tokens, hashes = lm.TOKEN.findall(t), lm.token_hashes(t).tolist()
        assert len(tokens) == len(hashes)
        for w, h in zip(tokens, hashes):
            assert known.setdefault(w, h) == h and h > 2
    assert len(set(known.values())) == len(known)
    lm._tables.cache_clear()


def test_every_code_point_has_the_class_of_the_pattern():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 50_000):
        text = "".join(f"a{chr(c)}a " for c in points[i:i + 50_000])
        assert len(lm.TOKEN.findall(text)) == len(lm.token_hashes(text))


def test_packed_lists_come_back():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 56, 5000))
    assert np.array_equal(lm._unpack_keys(lm._pack_keys(keys)), keys)
    counts = rng.choice([0, 1, 254, 255, 256, 1 << 40], 5000)
    assert np.array_equal(lm._unpack(lm._pack(counts)), counts)


def test_word_order_tells_target_from_background(spark, docs_of):
    """The same words in another order: beyond the reach of single words."""
    good, bad = "international organisation considered representation", "representation considered organisation international"
    rows = [*((k, good) for k in range(5)), *((10 + k, bad) for k in range(5)), (20, good), (21, bad)]
    targets = spark.createDataFrame([(k,) for k in range(5)], "doc_id bigint")
    score = {r.doc_id: r.score for r in lm.cross_entropy_difference(docs_of(rows), targets).collect()}
    assert score[20] > score[21] + 0.5


def test_held_out_good_documents_score_above_bad_ones(spark):
    labels = dict(table_rows(SF, "labels", "doc_id, quality"))
    rows = QUERIES["op10_lm_score"](spark, SF).collect()
    assert len(rows) == len(table_rows(SF, "documents", "doc_id"))
    assert not any(r.target and labels.get(r.doc_id) != 1 for r in rows)
    unseen = [(labels[r.doc_id], r.score) for r in rows if r.doc_id in labels and not r.target]
    good, bad = ([s for y, s in unseen if y == k] for k in (1, 0))
    assert np.median(good) > np.median(bad)
    print(np.median(good), np.median(bad))

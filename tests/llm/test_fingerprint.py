from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests_llm_tools import docs_of, table_rows  # noqa: F401
from vulnlake.llm import fingerprint as fp
from vulnlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def edited_of(texts):
    return [t[:len(t) - len(t) // 3] + n[:len(t) // 3] for t, n in zip(texts, texts[1:] + texts[:1])]


def test_query_edits_by_the_next_document(spark):
    rows = sorted(((i, t or "") for i, t in table_rows(SF, "documents", "doc_id, text")), reverse=True)
    texts = [t for _, t in rows]
    edited = edited_of(texts)
    got = {r.doc_id: r for r in QUERIES["op5_fingerprint"](spark, SF).collect()}
    assert len(got) == len(rows)
    prints = [got[i].fingerprint for i, _ in rows]
    by_text = {}
    for (i, t), e, nxt in zip(rows, edited, prints[1:] + prints[:1]):
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(e, r.edited_fingerprint) == r.edited_fingerprint
        assert r.near_edited == pytest.approx(fp.likeness(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(fp.likeness(r.fingerprint, nxt))
    near, far = [r.near_edited for r in got.values()], [r.near_next for r in got.values()]
    assert np.median(near) > 0.5 and np.median(far) < 0.2
    assert np.mean([a > b for a, b in zip(near, far)]) > 0.95


def by_order(rows):
    """The contract's order, with ties as the docstring says."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1] or ""), r[1] or ""))


def signed(text):
    h = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return h - (1 << 64) if h >> 63 else h


def test_rows_without_id_and_of_one_id_are_cut(spark, docs_of, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 10)
    rows = [(7, f"one of many {k}") for k in range(100)] + [(None, f"none of many {k}") for k in range(60)] + [(k, f"own {k}") for k in range(-40, 40)]
    dealt = fp.with_next(docs_of(rows)).where("not tail").withColumn("task", F.spark_partition_id()).collect()
    assert len(dealt) == len(rows)
    per_task = Counter(r.task for r in dealt)
    assert max(per_task.values()) <= 40 and len({r.task for r in dealt if r.doc_id == 7}) >= 3 and len({r.task for r in dealt if r.doc_id is None}) >= 3
    assert all(len({r.bucket for r in dealt if r.task == t}) == 1 for t in per_task)  # a bucket a partition
    ordered = by_order(rows)
    want = Counter((repr(i), hashlib.sha256(e.encode()).hexdigest()) for (i, _), e in zip(ordered, edited_of([t for _, t in ordered])))
    assert Counter((repr(r.doc_id), r.edited_sha256) for r in fp.neighbours(docs_of(rows)).collect()) == want


def test_fingerprints_equal_the_definition(spark, docs_of):
    """Rarity, points, features, filters and likeness written out, window by window."""
    rng = np.random.default_rng(11)
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(1, 12, 60)]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 5, 8, 60, 150, 400, 700)]
    classes = lambda x: [round(-sum(c / 16 * math.log2(c / 16) for c in Counter(x[k:k + 16]).values()) * 256) for k in range(len(x) - 15)]
    total = np.zeros(fp.CLASSES, np.int64)
    for t in texts:
        for c in classes(t.encode()):
            total[c] += 1
    order = sorted(range(fp.CLASSES), key=lambda c: (total[c], c))
    rank = {c: k for k, c in enumerate(order)}

    def window_hash(w, width):
        m = (1 << 64) - 1
        a, b = (int.from_bytes(w.ljust(16, b"\0")[k:k + 8], "little") for k in (0, 8))
        h = (a * 0x9E3779B97F4A7C15 + width) & m
        h ^= h >> 29
        h = ((h + b) * 0xBF58476D1CE4E5B9) & m
        h ^= h >> 32
        h = (h * 0x94D049BB133111EB) & m
        return h ^ (h >> 31)

    def features(x):
        if len(x) < 512:
            width = 16 if len(x) >= 64 else 4
            x = x.ljust(width, b"\0") if x else x
            return list(dict.fromkeys(window_hash(x[k:k + width], width) for k in range(len(x) - width + 1))) if x else []
        rare = [rank[c] for c in classes(x)]
        points = Counter(min(range(k, k + 32), key=lambda j: (rare[j], j)) for k in range(len(rare) - 31))
        return list(dict.fromkeys(window_hash(x[k:k + 16], 16) for k in range(len(rare)) if points[k] >= 12))

    def chain(found):
        return [{(h >> 11 * k) & 2047 for h in found[a:a + 160] for k in range(5)} for a in range(0, len(found), 160)]

    def like(p, q):
        if p == q:
            return 1.0
        if not p or not q:
            return 0.0
        p, q = sorted((p, q), key=lambda f: (len(chain(f)), len(f)))
        scored = []
        for k, f in enumerate(chain(p)):
            best = 0.0
            for g in chain(q):
                chance, most = len(f) * len(g) / 2048, min(len(f), len(g))
                best = max(best, min(1.0, max(0.0, (len(f & g) - chance) / max(most - chance, 1e-9))))
            scored.append((best, min(160, len(p) - 160 * k)))
        return sum(b * w for b, w in scored) / sum(w for _, w in scored)

    got = {r.doc_id: r for r in fp.neighbours(docs_of(list(enumerate(texts)))).collect()}
    turned = texts[::-1]
    for i, (t, e, n) in zip(range(len(texts))[::-1], zip(turned, edited_of(turned), turned[1:] + turned[:1])):
        own, edited, following = (features(x.encode()) for x in (t, e, n))
        for text, found in ((got[i].fingerprint, own), (got[i].edited_fingerprint, edited)):
            count, bits = fp.decode(text)
            assert count == len(found) and [set(np.flatnonzero(b).tolist()) for b in bits] == chain(found)
        assert got[i].near_edited == pytest.approx(like(own, edited), abs=1e-5) and got[i].near_next == pytest.approx(like(own, following), abs=1e-5)


def test_many_buckets_nulls_ties_and_one_row(spark, docs_of, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 3)
    rows = [(k * 3 - 20, f"text number {k} " * (k % 7)) for k in range(40)]
    rows += [(7, None), (8, ""), (8, "tie b"), (8, "tie a"), (None, "no id"), (None, "no id too"), (1000, "z" * 2_000)]
    ordered = by_order(rows)
    edited = edited_of([t or "" for _, t in ordered])
    want = sorted((repr(i), len(t or ""), hashlib.sha256(e.encode()).hexdigest()) for (i, t), e in zip(ordered, edited))
    got = fp.neighbours(docs_of(rows)).collect()
    assert sorted((repr(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == want
    assert all(r.fingerprint == "" for r in got if r.n_chars == 0)
    one = fp.neighbours(docs_of([(5, "alone in the table")])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"alone in the" + b"alone ").hexdigest()
    assert fp.neighbours(docs_of([])).count() == 0


def test_entropy_classes_equal_counting():
    rng = np.random.default_rng(3)
    for x in (rng.integers(97, 103, 400), rng.integers(0, 256, 300), np.full(100, 65), np.arange(16), np.arange(15)):
        x = x.astype(np.uint8)
        want = [round(-sum(c / 16 * math.log2(c / 16) for c in Counter(x[k:k + 16].tolist()).values()) * 256) for k in range(len(x) - 15)]
        assert np.abs(fp.entropy_classes(x) - np.array(want, int).reshape(-1)).max(initial=0) <= 1


def test_features_do_not_depend_on_how_texts_are_cut(monkeypatch):
    rng = np.random.default_rng(4)
    rank = rng.permutation(fp.CLASSES)
    texts = [bytes(rng.integers(97, 110, n, dtype=np.uint8)) for n in (0, 3, 40, 100, 600, 5000, 20_000)]
    whole = [fp.encode(h) for h in fp.features(texts, rank)]
    monkeypatch.setattr(fp, "SEGMENT", 700)
    assert [fp.encode(h) for h in fp.features(texts, rank)] == whole
    assert [fp.encode(fp.features([t], rank)[0]) for t in texts] == whole
    assert whole[0] == "" and fp.likeness(whole[0], whole[0]) == 1.0 and fp.likeness(whole[0], whole[4]) == 0.0
    assert all(0 <= fp.likeness(a, b) <= 1 and fp.likeness(a, b) == fp.likeness(b, a) for a in whole for b in whole)


def test_rarity_counts_the_windows_of_short_texts(spark, docs_of):
    rng = np.random.default_rng(5)
    texts = ["a" * 40, "abcdefghijklmnop", "abcdefghijklmno", "", "".join(map(chr, rng.integers(97, 123, 300))), "ab" * 400]
    total = np.zeros(fp.CLASSES, np.int64)
    for t in texts:
        total += np.bincount(fp.entropy_classes(np.frombuffer(t.encode(), np.uint8)), minlength=fp.CLASSES)
    rank = fp.rarity_table(docs_of([(k, t) for k, t in enumerate(texts)] + [(9, None)]))
    assert np.argsort(rank).tolist() == np.lexsort((np.arange(fp.CLASSES), total)).tolist()

from __future__ import annotations

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa

from tests_llm_tools import docs_of, table_rows  # noqa: F401
from vulnlake.llm import near_dedup as nd
from vulnlake.llm.common import components
from vulnlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 4:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k:k + 4]) for k in range(len(words) - 3))


def brute_force(rows):
    """(doc_id, n_shingles, component_id, kept), all pairs compared on full sets."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and None not in (a, b) and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    out = []
    for i, s in sets:
        c = None if i is None else find(i)
        out.append((i, len(s), c, i is None or i == c))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def near_copies(n, words=120, seed=5):
    """A chain-like group: every text differs from one base in a few places, so neighbours of a centre need not
    be linked to each other, and not all are linked to the centre."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            text[rng.randrange(words)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(text))
    return out


def test_query_equals_brute_force(spark):
    assert got(QUERIES["op4_near_dedup"](spark, SF)) == brute_force(table_rows(SF, "documents", "doc_id, text"))


def test_hot_group_short_texts_nulls_and_ties(spark, docs_of):
    rows = [(100 + k, t) for k, t in enumerate(near_copies(60))]
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "Two Words"), (5, "two\x0bWORDS"), (6, "two words more"), (7, "É é"), (8, "é é"),
             (9, "same id one two three four"), (9, "same id five six seven eight"), (10, "SAME id five six seven eight"),
             (None, "two words"), (50, rows[0][1]), (50, rows[0][1])]
    assert got(nd.near_duplicates(docs_of(rows))) == sorted(
        [r for r in brute_force([x for x in rows if x[0] != 9]) if r[0] != 10]
        + [(9, 3, 9, True), (9, 3, 9, True), (10, 3, 9, False)], key=repr)
    assert nd.near_duplicates(docs_of([])).count() == 0


def test_open_buckets_are_compared_whatever_the_rounds_and_blocks(spark, docs_of, monkeypatch):
    rows = list(enumerate(near_copies(40, words=60, seed=8)))
    want = brute_force(rows)
    assert len({r[2] for r in want}) > 1 and max(sum(r[2] == c for r in want) for c in range(40)) > 3
    for rounds, docs, size in ((0, 512, 8 << 20), (0, 7, 8 << 20), (1, 512, 2000)):
        monkeypatch.setattr(nd, "ROUNDS", rounds)
        monkeypatch.setattr(nd, "BLOCK_DOCS", docs)
        monkeypatch.setattr(nd, "BLOCK_BYTES", size)
        assert got(nd.near_duplicates(docs_of(rows))) == want, (rounds, docs, size)


def test_one_row_of_each_group_stays(spark, docs_of):
    a = near_copies(1, seed=3)[0]
    b = a + " more"
    docs = docs_of([(3, a), (1, a), (2, b), (5, "other text of five words"), (5, "other text of five words"), (None, a), (7, None)])
    out = nd.keep_one_each(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in out.collect()) == [(-1, a), (1, a), (5, "other text of five words"), (7, None)]


def test_odd_sketches_never_rule_out_a_pair_at_the_threshold():
    rng = np.random.default_rng(1)
    worst = 0
    for _ in range(200):
        u = rng.integers(0, 1 << 63, 450).astype(np.uint64)
        a, b = (nd.odd_sketch(nd.samples(s)) for s in (u[:405], u[45:]))  # similarity 0.8
        worst = max(worst, int(np.bitwise_count((a ^ b).view(np.uint64)).sum()))
    u, v = (nd.odd_sketch(nd.samples(rng.integers(0, 1 << 63, 400).astype(np.uint64))) for _ in range(2))
    assert worst <= nd.most_odd_bits() < int(np.bitwise_count((u ^ v).view(np.uint64)).sum())


def test_sets_of_sliced_columns_equal_those_of_single_texts():
    texts = [b"", b" ", b"One two", b"one TWO three four five", b"\xff\xfe x\x1cy \xc3", "É é É é É é É".encode(), b" a b\x0bc d a b c d a b c d ", b"x"]
    sets = nd.sets_of
    whole = sets(pa.array(texts, pa.binary()))
    assert [len(s) for s in whole] == [len(shingles(t.decode("latin-1").replace("\x85", "?").replace("\xa0", "?"))) for t in texts]
    for a in range(len(texts)):
        for z in range(a, len(texts) + 1):
            got_ = sets(pa.array([b"before", *texts], pa.binary())[1 + a:1 + z])
            assert len(got_) == z - a and all(map(np.array_equal, got_, whole[a:z]))
    named = [x for s in whole for x in s.tolist()]
    assert len(set(named)) == len({x for t in texts for x in shingles(t.decode("latin-1").replace("\x85", "?").replace("\xa0", "?"))})


def test_words_of_a_text_are_no_objects():
    """The cost of a gigabyte: a text's words are split, looked up and mixed as arrays, and so are the samples of a batch."""
    text = b"".join(b"word%d " % (k % 900) for k in range(400_000))
    column = pa.array([text], pa.binary())
    sets = nd.sets_of
    sets(column)
    tracemalloc.start()
    assert len(sets(column)[0]) == 900
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400_000 * 45
    minima = np.stack([nd.samples(s) for s in sets(pa.array([b"a b c d e f", b"g h i j k", b"a b c d e f"], pa.binary()))])
    assert np.array_equal(nd.band_keys(minima), [nd.band_keys(m) for m in minima])
    assert np.array_equal(nd.odd_sketch(minima), [nd.odd_sketch(m) for m in minima])


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 430)] + [(500, 900 + k) for k in range(50)]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want, seen = {}, set()
    for x in sorted(near):
        if x not in seen:
            stack, group = [x], set()
            while stack:
                y = stack.pop()
                if y not in group:
                    group.add(y)
                    stack.extend(near[y])
            seen |= group
            if len(group) > 1:
                want.update({y: x for y in group})
    got_ = {r.id: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got_ == want

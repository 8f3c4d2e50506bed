from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests_llm_tools import docs_of, table_rows  # noqa: F401
from vulnlake.llm import decontaminate as dc
from vulnlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_force(docs, items, window=13):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for win, owners in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    ids |= owners
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def got(df):
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    cols = df.select("doc_id", "n_words", "n_hit", F.size("items"), digest, "contaminated")
    return sorted((tuple(r) for r in cols.collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = QUERIES["op6_decontamination"](spark, SF)
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute_force(table_rows(SF, "documents", "doc_id, text"), table_rows(SF, "benchmark", "item_id, text"))
    assert sorted((tuple(r) for r in rows.select(*cols).collect()), key=repr) == want
    assert "op6_decontamination" in ORACLES


ITEM = "One two THREE four-five six, seven eight nine ten eleven twelve thirteen fourteen fifteen"


@pytest.mark.parametrize("most", [dc.BROADCAST_TERMS, 0])  # with and without the broadcast of terms
def test_short_items_overlaps_nulls_and_repeats(spark, docs_of, monkeypatch, most):
    monkeypatch.setattr(dc, "BROADCAST_TERMS", most)
    filler = " ".join(f"w{k}" for k in range(400))
    docs = [(1, ITEM), (2, "x " + ITEM.upper() + " y"), (3, filler + " " + ITEM), (4, filler + " " + " ".join(words(ITEM)[:12])), (5, None),
            (6, ""), (7, "the the the the"), (8, "É é ÉÉ"), (8, "É é ÉÉ"), (None, ITEM + " " + ITEM), (9, "one " * 13), (10, "short item"), (11, filler * 30),
            (12, " ".join(words(ITEM)[5:]) + " " + " ".join(words(ITEM)[::-1]))]  # terms too near the beginning for their place
    items = [(1, ITEM), (10, ITEM + " and more words"), (2, "Short item!"), (3, None), (4, " -- "), (None, "the the"), (5, "one " * 13), (6, "Éé"), (1, ITEM)]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("win", F.lit("clash"))
    assert got(dc.contamination(docs_of(docs), bench)) == brute_force(docs, items)
    assert got(dc.contamination(docs_of(docs), bench.limit(0))) == brute_force(docs, [])
    assert dc.contamination(docs_of([]), bench).count() == 0


def test_phrase_and_proximity_matches(spark, docs_of):
    stored = dc.stored_words(docs_of([(1, "red green blue x red x green y blue z blue green red"), (2, "green blue"), (3, "red a b c d e green blue")]))
    query = spark.createDataFrame([(["red", "green", "blue"],)], "win array<string>")
    ids = {r.row: r.doc_id for r in stored.collect()}
    phrase = sorted((ids[r.row], r.start) for r in dc.phrase_matches(stored, query).collect())
    assert phrase == [(1, 1)]
    text = {1: "red green blue x red x green y blue z blue green red".split(), 3: "red a b c d e green blue".split()}
    for slop in (0, 2, 3, 6):
        want = [(i, k + 1) for i, w in text.items() for k in range(len(w)) if w[k] in ("red", "green", "blue")
                and {"red", "green", "blue"} <= set(w[k:k + 3 + slop])]
        assert sorted((ids[r.row], r.start) for r in dc.proximity_matches(stored, query, slop).collect()) == want

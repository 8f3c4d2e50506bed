from __future__ import annotations

from collections import Counter

import pytest
from tokenizers import Tokenizer

from tests_llm_tools import docs_of, table_rows  # noqa: F401
from vulnlake.llm import token_counts as T
from vulnlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = {
    1: None, 2: "", 3: " ", 4: "  \n\n  x", 5: "It's we'll 'tis THEY'RE x's'", 6: "a <|endoftext|> b<|endoftext|>", 7: "<|endoftext|><|endof text|>",
    8: "z" * 70_000, 9: "12,345.67 ½ ² ①", 10: "中文。 日本語　x y", 11: "tab\tnew\r\n line   end ", 12: "՘࢏ ok \U00033000x",
    13: "é ‍👩‍👧 flags 🇫🇷", 14: "word " * 3 + "   " + "!!!???" * 40, 15: "same", 16: "same"}


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(T.default_tokenizer())


def truth(tokenizer, text):
    return len((text or "").encode()), len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_query_equals_the_tokenizer_on_whole_texts(spark, tokenizer):
    texts = dict(table_rows(SF, "documents", "doc_id, text"))
    rows = QUERIES["op11_token_counts"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n_bytes, n = truth(tokenizer, texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (n_bytes, n, n > 1024)


@pytest.mark.parametrize("entries", [1, 5, 65_536])
def test_edge_texts_with_any_first_tier(docs_of, tokenizer, entries):
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in T.count_tokens(docs_of(list(TEXTS.items()), extra=("id", "n_bytes", "n_tokens")),
                                                                     entries=entries).collect()}
    assert got == {i: truth(tokenizer, t) for i, t in TEXTS.items()}


@pytest.mark.parametrize("held", [3, 200_000])
def test_the_first_tier_is_counted_over_every_text(spark, monkeypatch, held):
    """Words of late rows and of any task count, those between special strings as they are looked up."""
    monkeypatch.setattr(T, "COUNTED", held)
    texts = [f"early{k % 9} word" for k in range(600)] + ["late"] * 700 + ["b<|endoftext|>b"] * 500 + ["y" * 65] * 2000 + [None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    lengths, want = T.Lengths(T.default_tokenizer()), Counter()
    for t in texts:
        want.update(w for part in (t or "").split("<|endoftext|>") for piece in lengths.words(part) for w in piece if len(w) <= T.CACHED)
    for tasks in (1, 130):
        chosen = []
        for entries in (1, 2, 3, 7, 99):
            got = T.frequent_lengths(docs.repartition(tasks), T.default_tokenizer(), entries=entries)
            assert sorted((want[w] for w in got), reverse=True) == sorted(want.values(), reverse=True)[:entries]
            assert list(got.values()) == lengths.encode(list(got))
            chosen.append(set(got))
        assert chosen[0] == {"b"} and chosen == sorted(chosen, key=len) and all(a <= b for a, b in zip(chosen, chosen[1:]))


def test_repeated_rows_null_ids_and_empty_tables(docs_of):
    rows = T.count_tokens(docs_of([(1, "a b"), (1, "a b"), (None, "a b c")])).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in rows) == [(False, 2), (False, 2), (True, 3)]
    empty = T.count_tokens(docs_of([]))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_bytes", "n_tokens"]


def test_long_texts_in_pieces_and_small_caches(monkeypatch, tokenizer):
    monkeypatch.setattr(T, "PIECE", 7)
    monkeypatch.setattr(T, "CACHE_ENTRIES", 3)
    lengths = T.Lengths(T.default_tokenizer())
    texts = [t or "" for t in TEXTS.values()] + ["one two  three\n\nfour don't " * 50]
    for frequent in ({}, {" two": 1, "one": 1}):
        assert lengths.count(texts, frequent) == [truth(tokenizer, t)[1] for t in texts]
    assert max(map(len, lengths.cache), default=0) <= T.CACHED


def test_every_code_point_is_split_as_the_tokenizer_does(tokenizer):
    """Letters, digits, white space and the rest are told apart as the tokenizer does, or the text goes to it whole."""
    lengths, points = T.Lengths(T.default_tokenizer()), [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4000):
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)} a" for c in points[i:i + 4000] if not lengths.unassigned.match(chr(c)))
        assert lengths.pattern.findall(text) == [text[a:z] for _, (a, z) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    assert lengths._whole("x ՘") and not lengths._whole("é 中")


def test_words_are_looked_up_whole(tokenizer, monkeypatch):
    """One lookup a word, whatever pre-tokens it has; white space and words join the pre-tokens of the tokenizer."""
    lengths, points = T.Lengths(T.default_tokenizer()), [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4000):
        text = "".join(f"a{chr(c)}1  {chr(c)}! {chr(c)} \n{chr(c)}{chr(c)}a" for c in points[i:i + 4000])
        cuts, at = {a for _, (a, _) in tokenizer.pre_tokenizer.pre_tokenize_str(text)}, 0
        for word in (w for piece in lengths.words(text) for w in piece):
            assert at in cuts and text.startswith(word, at)
            at += len(word)
        assert at == len(text)
    asked = []
    monkeypatch.setattr(lengths, "encode", lambda words: asked.extend(words) or [0] * len(words))
    text = "Well, it's (really) 2,000 odd: don't\n  you-know?"
    words = {"Well,": 2, " it's": 2, " (really)": 3, " 2,000": 4, " odd:": 2, " don't": 2, "\n ": 1, " you-know?": 4}
    assert lengths.count([text], words) == [sum(words.values())] and not asked
    assert [w for piece in lengths.words(text) for w in piece] == list(words)


def test_long_words_empty_the_cache_without_loss(tokenizer, monkeypatch):
    monkeypatch.setattr(T, "CACHE_ENTRIES", 2)
    lengths = T.Lengths(T.default_tokenizer())
    texts = ["one two three", "one two " + "a,b;" * 40 + " three one \u0558" + "x." * 40, "two " + "\u4e2d\u6587\u3002" * 90 + " one"]
    for _ in range(2):
        assert lengths.count(texts, {}) == [truth(tokenizer, t)[1] for t in texts]


def test_other_splitters_go_to_the_tokenizer_whole():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    lengths, whole = T.Lengths(path), Tokenizer.from_file(path)
    assert not lengths.by_pretoken
    texts = ["Some Words, here.", "x <|endoftext|> y"]
    assert lengths.count(texts, {}) == [len(whole.encode(t, add_special_tokens=False).ids) for t in texts]


def test_no_shuffle_of_the_corpus(docs_of):
    plan = T.count_tokens(docs_of([(1, "a")]))._jdf.queryExecution().toString()
    assert "Exchange" not in plan

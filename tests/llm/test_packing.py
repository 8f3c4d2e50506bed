from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests_llm_tools import docs_of, table_rows  # noqa: F401
from vulnlake.llm.packing import TAIL, WordCache, complete_bins, default_tokenizer, lower_bound, pack
from vulnlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def check(rows, texts, tokenizer, capacity):
    """Every contract column against the tokenizer run on whole texts; returns the number of sequences."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [(p.piece, p.start, p.length) for p in pieces] == [
            (k, a, min(capacity, len(ids) - a)) for k, a in enumerate(range(0, len(ids), capacity))]
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
    for members in by_seq.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_seq)


def test_query_is_whole_gapless_and_tight(spark):
    texts = dict(table_rows(SF, "documents", "doc_id, text"))
    rows = QUERIES["op3_packing"](spark, SF).collect()
    n = check(rows, texts, Tokenizer.from_file(default_tokenizer()), 2048)
    counts = [0] * 2049
    for r in rows:
        counts[r.length] += 1
    assert n <= lower_bound(counts, 2048) + 1


def test_small_capacity_nulls_and_repeated_rows(spark, docs_of):
    texts = {1: None, 2: "", 3: "the cat sat on the mat " * 30, 4: "a <|endoftext|> b", 5: "x" * 5000, 6: "É é!! don't."}
    rows = pack(docs_of(list(texts.items())), capacity=16).collect()
    check(rows, texts, Tokenizer.from_file(default_tokenizer()), 16)
    twice = pack(docs_of([(1, "same text"), (1, "same text")]), capacity=16).collect()
    assert len(twice) == 2 and len({(r.sequence_id, r.offset) for r in twice}) == 2
    assert pack(docs_of([]), capacity=16).count() == 0


@pytest.mark.parametrize("text", [
    "Plain words, with. punctuation! and (brackets).", "don't it's WE'VE 'tis x.'s", "İstanbul ΣΑΣ ſ. K. ﬁ. ǅ! ①.", "中文。 中.", "1st 2.5 a1b2 1,000.",
    "a b　c\x1cd e", "<|startoftext|>a <|STARTOFTEXT|> x<|endoftext|>y.", "...a!! «é». -- __", "é. É!", "tab\tnew\nline\r\n"])
def test_word_cache_equals_the_tokenizer(text):
    cache, whole = WordCache(default_tokenizer()), Tokenizer.from_file(default_tokenizer())
    for _ in range(2):  # the second time from the cache
        ids = np.frombuffer(cache.encode([text.encode()])[0], "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def caches():
    return WordCache(default_tokenizer()), Tokenizer.from_file(default_tokenizer())


def ids_of(cache, texts):
    return [np.frombuffer(b, "<u4").tolist() for b in cache.encode([t.encode() for t in texts])]


def test_every_code_point_before_every_trailing_mark(caches):
    """Each code point as the last of a word, before each mark that is cut off and before two."""
    cache, whole = caches
    assert cache.by_word
    marks = [chr(b) for b in TAIL] + ["?!", ".*"]
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    letters = [c for c in points if chr(c).isalpha()]
    assert len(letters) > 100_000
    for k, mark in enumerate(marks):  # every code point before the full stop, every letter before one of the others as well
        for chunk in np.array_split(points if mark == "." else letters[k::len(marks)], 60 if mark == "." else 4):
            text = " ".join(f"{chr(c)}{mark}" if c % 3 else f"x{chr(c)}{mark}" for c in chunk.tolist())
            assert ids_of(cache, [text]) == [whole.encode(text, add_special_tokens=False).ids], hex(int(chunk[0]))


@given(st.lists(st.text(st.sampled_from("İiſKßΣςǅﬁé\u0301\u0307\u0308\u0345\u0f52\u0958\u1e9e\u2126①中a1'sTt<|.?!,; \u00a0\u3000\n")), max_size=4))
@settings(max_examples=300, deadline=None)
def test_texts_rich_in_odd_letters(caches, texts):
    cache, whole = caches
    assert ids_of(cache, texts) == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_white_space_at_the_ends_empty_texts_and_bytes_that_are_no_text(caches):
    cache, whole = caches
    texts = [" a  b\x0b", "", "\t", "\x00 \x1c. <", "x" * 70 + ". " + "é" * 70 + "?", " ", "Δ.", "a"]
    assert ids_of(cache, texts) == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(cache, ["", " "]) == [[], []] and cache.encode([]) == []
    assert all(len(p) <= 64 for p in cache.cache)
    odd = b"a\xff. \xc3 b\xe4\xb8."
    assert np.frombuffer(cache.encode([odd])[0], "<u4").tolist() == whole.encode(odd.decode("utf-8", "replace"), add_special_tokens=False).ids


def test_words_of_a_text_are_no_objects(caches):
    """The cost of a gigabyte: a text's words are split, looked up and put in place as arrays."""
    import tracemalloc

    cache, whole = caches
    text = "".join(f"Word{k % 900}, " for k in range(400_000))
    want = whole.encode(text, add_special_tokens=False).ids
    cache.encode([text.encode()])
    tracemalloc.start()
    got = cache.encode([text.encode()])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.frombuffer(got, "<u4").tolist() == want
    assert peak < len(text) + 3 * len(got) + 400_000 * 20


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    cache, whole = WordCache(path), Tokenizer.from_file(path)
    assert not cache.by_word
    texts = ["Some words,  here. İ?", "x <|endoftext|> y", ""]
    assert ids_of(cache, texts) == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_hard_lengths_stay_near_the_bound():
    """Lengths of a sixth to a half of a sequence, where few fillings are exact: README states the gap."""
    for seed in range(6):
        rng = random.Random(seed)
        counts = [0] * 2049
        for _ in range(400):
            counts[rng.randint(340, 1030)] += 1
        used = sum(t for _, t in complete_bins(counts))
        assert lower_bound(counts, 2048) <= used <= 1.08 * lower_bound(counts, 2048)


@pytest.mark.parametrize("seed", range(12))
def test_bin_completion_uses_every_piece_and_is_tight(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 100, 2048])
    counts = [0] * (capacity + 1)
    for _ in range(rng.choice([1, 7, 60, 900])):
        counts[min(capacity, max(1, int(rng.lognormvariate(np.log(capacity) - 1, 1))))] += 1
    patterns = complete_bins(counts, capacity)
    used = Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= capacity and times > 0
        for x in pattern:
            used[x] += times
    assert used == Counter({x: c for x, c in enumerate(counts) if c})
    assert sum(t for _, t in patterns) <= lower_bound(counts, capacity) * 1.02 + 1


def test_perfect_fillings_are_found():
    counts = [0] * 11
    for x in (6, 5, 5, 4, 4, 3, 3):
        counts[x] += 1
    assert sum(t for _, t in complete_bins(counts, 10)) == 3
    assert complete_bins([0] * 11, 10) == []

"""Token counts by a map-side two-tier lookup.

A byte-level BPE cuts a text into pre-tokens by a fixed pattern and merges bytes inside each alone, so a text's
token count is the sum of its pre-tokens' lengths in tokens. No pre-token reaches from a character into white space
behind it, so the pre-tokens of a word (with the one space before it) are the same in the text and alone: texts are cut
at white space only, which a much simpler pattern does, and the words' lengths are looked up.

1. First tier: the lengths of the corpus's most frequent words, a hash table of at most ``FREQUENT`` short strings,
   broadcast. Which they are is counted over every word of every text. The choice only decides how often the first
   tier is hit; every length is the tokenizer's own.
2. Second tier: what misses goes to a cache in each worker, and what misses there as well is encoded, the unseen
   words of about a megabyte of text in one call. The cache is emptied when it is full. Words of more than ``CACHED``
   characters (text without spaces) are cut into their pre-tokens, which go the same way.

Texts never leave their task, and lengths are looked up without a shuffle. What is shuffled are the counts that choose
the first tier, one row per distinct short word of a task (of each ``COUNTED`` distinct ones where there are more).

Defined cases: null texts count as empty (0 bytes, 0 tokens); null and repeated ids are kept, one row out per row in;
texts of any length are read whole, in bounded pieces of their words and pre-tokens; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored, table

LIMIT = 1024
FREQUENT = 65_536  # entries of the first tier
COUNTED = 200_000  # distinct words whose counts a task holds at once
CACHED = 64  # longer words and pre-tokens are in neither tier
CACHE_ENTRIES = 500_000  # of a worker's second tier
PIECE = 200_000  # words or pre-tokens of one text held at a time
GROUP = 1 << 20  # bytes of texts looked up together

# Fixed value: the splitting pattern of byte-level BPE vocabularies of this kind.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same with the pre-tokens between white space left together. White space is spelled out: Python's has more.
_ASCII_SPACE, _SPACE = r"\t-\r ", r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ASCII_WORD, WORD = (re.compile(f" ?[^{s}]+|[{s}]+(?![^{s}])|[{s}]") for s in (_ASCII_SPACE, _SPACE))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _unassigned() -> re.Pattern:
    """Code points that this Python's character tables do not know. The pattern engine's tables may be newer than
    the tokenizer's and tell letters apart that the latter does not."""
    spans, start = [], None
    for c in range(sys.maxunicode + 2):
        out = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if out and start is None:
            start = c
        elif not out and start is not None:
            spans.append((start, c - 1))
            start = None
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in spans) + "]")


class Lengths:
    """Token counts of texts, through the first tier ``frequent`` and this worker's cache."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        split = parts.get("pre_tokenizer") or {}
        #: whether lengths of pre-tokens add up to the length of the text
        self.by_pretoken = (
            parts.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space") and not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added))
        self.pattern = regex.compile(PRETOKEN)
        names = sorted((t.content for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.unassigned = _unassigned()
        self.cache: dict[str, int] = {}

    def encode(self, pretokens: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)]

    @staticmethod
    def _found(pattern, text: str) -> Iterator[list[str]]:
        """What ``pattern`` finds in the text, in lists of at most ``PIECE``."""
        if len(text) <= PIECE:
            yield pattern.findall(text)
            return
        found = (m.group() for m in pattern.finditer(text))
        while piece := list(itertools.islice(found, PIECE)):
            yield piece

    def words(self, text: str) -> Iterator[list[str]]:
        """Words, with the space before them, and white space of a text without special strings, in lists of bounded length."""
        return self._found(ASCII_WORD if text.isascii() else WORD, text)

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens of a text without special strings, in lists of bounded length."""
        return self._found(self.pattern, text)

    def _whole(self, text: str) -> bool:
        return not self.by_pretoken or (not text.isascii() and self.unassigned.search(text) is not None)

    def _plain(self, text: str) -> tuple[int, Iterable[str]]:
        """The number of special strings in the text, and what is between them."""
        if self.special is not None and (names := len(self.special.findall(text))):
            return names, self.special.split(text)
        return 0, (text,)

    def looked_up(self, text: str) -> Iterator[list[str]]:
        """What the first tier may hold of a text: its words of at most ``CACHED`` characters, in lists of bounded length."""
        for part in self._plain(text)[1]:
            for piece in self.words(part):
                yield piece if max(map(len, piece), default=0) <= CACHED else [p for p in piece if len(p) <= CACHED]

    def count(self, texts: list[str], frequent: dict[str, int]) -> list[int]:
        totals, missed = [0] * len(texts), []
        for k, text in enumerate(texts):
            if not self.by_pretoken:
                totals[k] = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
                continue
            totals[k], plain = self._plain(text)
            for part in plain:
                for piece in self.words(part):
                    found = list(map(frequent.get, piece))
                    totals[k] += sum(filter(None, found))
                    if None in found:
                        rest = [p for p, n in zip(piece, found) if n is None]
                        if len(piece) < PIECE:
                            missed.append((k, rest))
                        else:  # a long text: settle its pieces one by one
                            totals[k] += self._settle([(k, rest)])[0]
        for (k, _), n in zip(missed, self._settle(missed)):
            totals[k] += n
        return totals

    def _long(self, word: str) -> int:
        """Tokens of a word that is in no tier."""
        if self._whole(word):
            return len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        return sum(self._settle([(0, piece)], self.encode)[0] for piece in self.pieces(word))

    def _lengths(self, words: list[str]) -> list[int]:
        short = [w for w in words if len(w) <= CACHED]
        known = dict(zip(short, self.encode(short)))
        return [known[w] if w in known else self._long(w) for w in words]

    def _settle(self, missed: list[tuple[int, list[str]]], encode: Callable[[list[str]], list[int]] | None = None) -> list[int]:
        cache = self.cache
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        wanted = {p for _, rest in missed for p in rest}
        known = {p: cache[p] for p in wanted if p in cache}
        new = [p for p in wanted if p not in known]
        got = dict(zip(new, (encode or self._lengths)(new)))
        cache.update((p, n) for p, n in got.items() if len(p) <= CACHED)
        known.update(got)
        return [sum(map(known.__getitem__, rest)) for _, rest in missed]


@functools.lru_cache(maxsize=2)
def lengths_of(path: str) -> Lengths:
    return Lengths(path)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Groups of about ``GROUP`` bytes of a binary column: the first row's number and the values."""
    values, at = batch.column(column), 0
    while at < len(values):
        group, size = [], 0
        while at + len(group) < len(values) and (not group or size < GROUP):
            group.append(values[at + len(group)].as_py() or b"")
            size += len(group[-1])
        yield at, group
        at += len(group)


def frequent_lengths(docs: DataFrame, tokenizer: str, text: str = "text", entries: int = FREQUENT) -> dict[str, int]:
    """The first tier: the ``entries`` most frequent words of at most ``CACHED`` characters of all texts, and their lengths.
    Of words that are as frequent as each other, the first by a hash are taken."""
    if not lengths_of(tokenizer).by_pretoken:
        return {}
    source = docs.select(F.col(text).cast("binary").alias("text"))

    def counts(seen: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, seen = lengths_of(tokenizer), Counter()
        for b in batches:
            for _, group in _texts(b, 0):
                for piece in (p for data in group for p in lengths.looked_up(data.decode("utf-8", "replace"))):
                    seen.update(piece)
                    if len(seen) >= COUNTED:
                        yield counts(seen)
                        seen.clear()
        if seen:
            yield counts(seen)

    counted = stored(map_batches(source, count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "word-counts", "zstd")
    # Words are chosen by how many there are of each n, so the driver gets no more of them than it keeps, and as many again of
    # the last n. There are not more different n than the square root of twice the corpus's words.
    chosen, left = F.lit(True), entries
    for n, words in counted.groupBy("n").agg(F.count(F.lit(1))).orderBy(F.desc("n")).collect():
        if words > left:
            chosen = F.col("n") > n
            break
        left -= words
    else:
        left = 0
    top = [r["word"] for r in counted.where(chosen).select("word").collect()]
    if left:
        at, near = F.xxhash64("word"), min(2**63 - 1, -2**63 + (2 * left + 100) * 2**64 // words)
        top += [r["word"] for r in counted.where((F.col("n") == n) & (at <= near)).orderBy(at, "word").limit(left).select("word").collect()]
    return dict(zip(top, lengths_of(tokenizer).encode(top)))


def count_tokens(docs: DataFrame, tokenizer: str | None = None, id: str = "doc_id", text: str = "text",
                 entries: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes`` (UTF-8) and ``n_tokens`` of its whole text."""
    path = tokenizer or default_tokenizer()
    first = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text, entries))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, frequent = lengths_of(path), first.value
        for b in batches:
            sizes, tokens = [], []
            for _, group in _texts(b, 1):
                sizes += map(len, group)
                tokens += lengths.count([data.decode("utf-8", "replace") for data in group], frequent)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], names)

    source = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))
    names = [id, "n_bytes", "n_tokens"]
    kind = source.schema["id"].dataType.simpleString()
    return map_batches(source, count, f"`{id}` {kind}, n_bytes bigint, n_tokens bigint")


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every whole document by the byte-level BPE, and whether they are more than ``LIMIT``."""
    return count_tokens(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > LIMIT)

"""Best-fit packing of token sequences by bin completion.

1. Each task tokenizes its documents (a bounded cache of words in front of the tokenizer), cuts documents longer
   than a sequence into pieces, and numbers the pieces of each length within the task. The pieces are stored.
2. Packing only needs to know how many pieces there are of each length: at most ``capacity`` counts, whatever
   the corpus size. Bin completion runs over these counts: take the largest length left, enumerate undominated
   fillings of the rest of its sequence, keep the best fit and repeat it as often as the counts allow. That is
   the incumbent; branch and bound then backtracks over the other fillings, pruned by the waste that a better
   solution could still afford, until the incumbent meets the lower bound or the node budget ends.
3. The plan (one entry per pattern and length; a pattern has at most 63 distinct lengths) is broadcast. Every
   piece gets its rank among the pieces of its length, from per-task counts, and finds its sequence and offset
   by binary search. No pieces meet in one task to be packed.

Defined cases: null and empty texts are one closing token; texts of any length are tokenized whole, one text at a time;
repeated rows are packed as often as they occur; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_words, distinct_words, groups, map_batches, stored, table, text_or_empty

CAPACITY = 2048
CACHE_PARTS = 1_200_000  # entries of a worker's cache; one that grows beyond this is emptied
GROUP = 4 << 20  # bytes of texts encoded together
PLACES = 1 << 16  # runs of ids put in place at once
CACHED_PART = 64  # longer parts of words are not cached
TAIL = b".,!?;:*#$%&|"
ALNUM = np.array([bytes([b]).isalnum() for b in range(256)])  # ASCII letters and digits
# How the tokenizers that ``WordCache`` takes apart normalise and split, as their files say.
KIND = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "</w>")
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, idx bigint"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordCache:
    """Token ids of a text as little-endian uint32 bytes.

    A tokenizer of ``KIND`` normalises, then splits at white space and between letters or digits and punctuation before it
    merges; so a text's ids are those of its words in turn (cut at ASCII white space only), and a word's are
    those of its lower-case core and of the punctuation behind it, if the normalised core ends in a letter or
    digit. Texts are cut into words and words into these parts by Arrow, many texts to a call; distinct parts are looked
    up, and each unseen part is encoded once, many to a call. A tokenizer of another kind is given whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        self.by_word = (parts.get("normalizer"), parts.get("pre_tokenizer"), parts["model"].get("end_of_word_suffix")) == KIND and not any(
            t.lstrip or t.rstrip or t.single_word or t.normalized or b"<" not in t.content.encode() or t.content.split() != [t.content]
            for t in self.tokenizer.get_added_tokens_decoder().values())
        # words of a-z are what normalising and splitting leave as they are: the same merges without these two
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)  # ids that end a word
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.cache: dict[bytes, bytes] = {}

    def _learn(self, parts: list[bytes]) -> None:
        """Put the ids of ``parts`` into the cache."""
        cache, plain, letters, other = self.cache, [], [], []
        for w in parts:
            if w.isalpha() and w.islower():
                plain.append(w)
            elif w.isalpha() or (not w.isascii() and w.decode("utf-8", "replace").isalpha()):
                letters.append(w)
            else:
                other.append(w)
        for tokenizer, words in ((self.merges, plain), (self.tokenizer, letters)):  # letters only: one word to the tokenizer, and one closing id
            for i in range(0, len(words), 2048):
                chunk = words[i:i + 2048]
                text = b" ".join(chunk).decode("utf-8", "replace")
                ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                data, cut = ids.tobytes(), ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
                if len(cut) != len(chunk) or cut[-1] != len(data):
                    other.extend(chunk)
                    continue
                cache.update(zip(chunk, map(data.__getitem__, map(slice, [0, *cut], cut))))
        for w in other:
            cache[w] = np.array(self.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def _ends_in_letter(self, core: bytes) -> bool:
        """Whether the normalised core ends in a letter: what normalising leaves last may be a mark, which would stay
        with the punctuation behind it."""
        t = core.decode("utf-8", "replace")
        return t[-1].isalpha() and self.tokenizer.normalizer.normalize_str(t)[-1:].isalpha()

    def _parts(self, words: pa.Array) -> pa.Array:
        """Two parts of every word in turn, the lower-case core and the punctuation behind it; or the word and nothing."""
        strings = words.view(pa.large_string())
        special = pc.match_substring(strings, "<").to_numpy(zero_copy_only=False)  # maybe a special token
        # ASCII words may be lower-cased here; in others normalising comes first: a small letter may take a mark that the large one leaves
        fixed = special | ~pc.string_is_ascii(strings).to_numpy(zero_copy_only=False)
        begin = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[begin[0]:begin[-1]]
        begin = begin - begin[0]
        size = np.diff(begin)
        large = (data >= ord("A")) & (data <= ord("Z")) & ~np.repeat(fixed, size)
        data = np.where(large, data + 32, data)
        core = pc.binary_length(pc.ascii_rtrim(strings, TAIL.decode())).to_numpy(zero_copy_only=False)
        apart = np.flatnonzero((core > 0) & (core < size) & ~special)
        last = data[begin[apart] + core[apart] - 1]
        ends = ALNUM[last]
        for k in np.flatnonzero(last >= 128).tolist():
            at = begin[apart[k]]
            ends[k] = self._ends_in_letter(data[at:at + core[apart[k]]].tobytes())
        cut = begin[1:].copy()
        cut[apart[ends]] = (begin[:-1] + core)[apart[ends]]
        edges = np.append(np.column_stack([begin[:-1], cut]).ravel(), begin[-1:])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * len(words), [None, pa.py_buffer(edges), pa.py_buffer(data)])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return [np.array(self.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        words, places, begin = distinct_words(pa.array(texts, pa.large_binary()))
        if not len(places):
            return [b""] * len(texts)
        coded = self._parts(words).dictionary_encode()
        parts, cache = as_words(coded.dictionary), self.cache
        if len(cache) > CACHE_PARTS:
            cache.clear()
        self._learn([p for p in parts if p not in cache])
        found = list(map(cache.__getitem__, parts))
        for p in [p for p in parts if len(p) > CACHED_PART]:
            del cache[p]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        which = coded.indices.to_numpy()
        ids = np.frombuffer(b"".join(spread(np.frombuffer(b"".join(found), "<u4"), size, which)), "<u4")  # of the distinct words
        size = size[which].reshape(-1, 2).sum(1)
        total = np.cumsum(size[places])
        ends = [4 * int(total[k - 1]) if k else 0 for k in begin.tolist()]
        del total
        data = memoryview(b"".join(spread(ids, size, places)))
        return [bytes(data[a:z]) for a, z in zip(ends, ends[1:])]


def spread(values: np.ndarray, size: np.ndarray, which: np.ndarray) -> Iterator[np.ndarray]:
    """``values`` holds runs of ``size`` values, one behind the other: the runs numbered ``which``, one behind the other,
    in arrays of ``PLACES`` runs."""
    first = np.cumsum(size) - size
    for k in range(0, len(which), PLACES):
        at = which[k:k + PLACES]
        n = size[at]
        yield values[np.repeat(first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]


@functools.lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    return WordCache(path)


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``docs(doc_id, text)`` -> stored pieces: doc_id, piece, start, length, ids_crc32, and part/idx: the task
    that cut it and its number among that task's pieces of the same length."""
    closing = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, numbers, cache = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), word_cache(tokenizer)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for i, j in groups(pc.binary_length(texts).to_pylist(), GROUP):
                rows = []
                for doc_id, data in zip(ids[i:j], cache.encode(texts[i:j].to_pylist())):
                    data += closing
                    n = len(data) // 4
                    for k, start in enumerate(range(0, n, capacity)):
                        length = min(capacity, n - start)
                        rows.append((doc_id, k, start, length, zlib.crc32(data[4 * start:4 * (start + length)]), part, int(numbers[length])))
                        numbers[length] += 1
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "idx"])

    return stored(map_batches(docs.select("doc_id", text_or_empty().cast("binary").alias("text")), cut, PIECES), "pieces")


# ---- bin completion over the counts of each length ----------------------------------------------------------

def fillings(counts: list[int], lengths: list[int], room: int, budget: int = 2000, keep: int = 6) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room``, least waste first, larger items first among equals.

    ``lengths``: those with a count, descending. A filling is dominated when one of its items could give way to
    a larger one that is left and still fits: the larger item is harder to place later. The search stops at an
    exact fit or after ``budget`` nodes; the best fit by greedy descent is always among the nodes.
    """
    best: dict[tuple[int, ...], int] = {}
    nodes = 0
    used: dict[int, int] = {}

    def left(x: int) -> int:
        return counts[x] - used.get(x, 0)

    def dominated(items: tuple[int, ...], rest: int) -> bool:
        return any(left(y) > 0 for x in set(items) for y in range(x + 1, x + rest + 1) if y <= room)

    def descend(at: int, rest: int, items: tuple[int, ...]) -> bool:
        nonlocal nodes
        nodes += 1
        if rest <= room and rest > 0 and left(rest) > 0:
            best[items + (rest,)] = 0
            return True
        fits = False
        while at < len(lengths) and lengths[at] > rest:
            at += 1
        for k in range(at, len(lengths)):
            x = lengths[k]
            if left(x) <= 0:
                continue
            fits = True
            used[x] = used.get(x, 0) + 1
            hit = descend(k, rest - x, items + (x,)) if rest > x else best.setdefault(items + (x,), 0) == 0
            used[x] -= 1
            if hit:
                return True
            if nodes >= budget:
                break
        if not fits and (rest == 0 or rest < 64 or not dominated(items, min(rest, 64))):
            best.setdefault(items, rest)
        return False

    if room:
        descend(0, room, ())
    ranked = sorted(best.items(), key=lambda kv: (kv[1], [-x for x in kv[0]]))
    return [items for items, _ in ranked[:keep]] or [()]


def lower_bound(counts: list[int], capacity: int) -> int:
    """Largest of the volume bound and the bounds that set items above ``capacity - k`` apart (k <= half)."""
    lengths = [x for x in range(1, capacity + 1) if counts[x]]
    best = ceil(sum(x * counts[x] for x in lengths) / capacity)
    for k in {0, *(x for x in lengths if x <= capacity // 2)}:
        big = sum(counts[x] for x in lengths if x > capacity - k)
        mid = [x for x in lengths if capacity // 2 < x <= capacity - k]
        small = sum(x * counts[x] for x in lengths if k <= x <= capacity // 2)
        n_mid = sum(counts[x] for x in mid)
        free = n_mid * capacity - sum(x * counts[x] for x in mid)
        best = max(best, big + n_mid + max(0, ceil((small - free) / capacity)))
    return best


def complete_bins(counts: list[int], capacity: int = CAPACITY, nodes: int = 300) -> list[tuple[tuple[int, ...], int]]:
    """Patterns ``(lengths of one sequence, how often)`` that use every count once.

    ``nodes`` bounds the fillings tried after the first descent.
    """
    counts, bound = list(counts), lower_bound(counts, capacity)
    total = sum(x * c for x, c in enumerate(counts))
    incumbent: list[tuple[tuple[int, ...], int]] | None = None
    incumbent_bins, tried = 1 << 62, 0
    path: list[list] = []  # [pattern, times, alternatives left]
    bins = waste = 0

    def options() -> list[tuple[int, ...]]:
        lengths = [x for x in range(capacity, 0, -1) if counts[x]]
        top = lengths[0]
        counts[top] -= 1
        out = [(top, *f) for f in fillings(counts, lengths if counts[top] else lengths[1:], capacity - top)]
        counts[top] += 1
        return out

    def apply(pattern: tuple[int, ...], sign: int, times: int) -> None:
        for x in pattern:
            counts[x] -= sign * times

    def push(alternatives: list[tuple[int, ...]]) -> None:
        nonlocal bins, waste
        pattern = alternatives[0]
        times = min(counts[x] // pattern.count(x) for x in set(pattern))
        apply(pattern, 1, times)
        bins, waste = bins + times, waste + times * (capacity - sum(pattern))
        path.append([pattern, times, alternatives[1:]])

    def pop() -> list[tuple[int, ...]]:
        nonlocal bins, waste
        pattern, times, rest = path.pop()
        apply(pattern, -1, times)
        bins, waste = bins - times, waste - times * (capacity - sum(pattern))
        return rest

    remaining = total
    while True:
        remaining = total - (bins * capacity - waste)
        if remaining == 0:
            if bins < incumbent_bins:
                incumbent, incumbent_bins = [(p, t) for p, t, _ in path], bins
            alternatives = []
        elif waste > (incumbent_bins - 1) * capacity - total:  # no better solution can afford this waste
            alternatives = []
        else:
            alternatives = options()
            tried += incumbent is not None
        while not alternatives and path and incumbent_bins > bound and tried < nodes:
            alternatives = pop()
        if not alternatives or (incumbent is not None and (incumbent_bins <= bound or tried >= nodes)):
            return incumbent or []
        push(alternatives)


def plan_tables(patterns: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """For every length, by rank: where the ranks of an entry begin, how many a sequence takes, the entry's
    first sequence, and the offset of the length's first piece there. ``first[length]`` indexes the entries."""
    entries: list[list[tuple[int, int, int, int]]] = [[] for _ in range(capacity + 2)]
    used, sequence = [0] * (capacity + 2), 0
    for pattern, times in patterns:
        offset = 0
        for x in sorted(set(pattern), reverse=True):
            n = pattern.count(x)
            entries[x].append((used[x], n, sequence, offset))
            used[x] += n * times
            offset += n * x
        sequence += times
    flat = np.array([e for per in entries for e in per], np.int64).reshape(-1, 4)
    first = np.cumsum([0] + [len(per) for per in entries])
    return {"begin": flat[:, 0], "each": flat[:, 1], "sequence": flat[:, 2], "offset": flat[:, 3], "first": first}


def place(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = 300) -> DataFrame:
    """Stored ``pieces`` -> the same rows with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    per_task = stored(pieces.groupBy("length", "part").count(), "piece-counts")
    counts = [0] * (capacity + 1)
    for row in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    plan = spark.sparkContext.broadcast(plan_tables(complete_bins(counts, capacity, nodes), capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("idx") + F.col("base")).alias("rank"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = plan.value
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            entry = np.empty(len(rank), np.int64)
            for x in np.unique(length):
                mine = length == x
                lo, hi = t["first"][x], t["first"][x + 1]
                entry[mine] = lo + np.searchsorted(t["begin"][lo:hi], rank[mine], "right") - 1
            within = rank - t["begin"][entry]
            sequence = t["sequence"][entry] + within // t["each"][entry]
            offset = t["offset"][entry] + within % t["each"][entry] * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return map_batches(ranked, assign, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, nodes: int = 300) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``capacity`` tokens, one row per piece."""
    return place(cut_pieces(docs, tokenizer or default_tokenizer(), capacity), capacity, nodes)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

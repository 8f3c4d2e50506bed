"""Document fingerprints: digests of improbable features in chained Bloom filters.

A feature is a window of ``WINDOW`` bytes. Its rarity is how seldom windows of its entropy occur in the whole
corpus (one pass counts all windows of all texts by entropy class; the table has at most ``CLASSES`` rows).
Sliding over the text, each stretch of ``STRETCH`` windows gives a point to its rarest, leftmost window;
windows with at least ``POINTS`` points are features. Texts below ``SHORT`` bytes use all their windows, and
texts below ``TINY`` bytes use windows of four bytes. Distinct features enter, in text order, a chain of Bloom
filters of 2048 bits, five bits a feature and 160 features a filter. The likeness of two fingerprints is the
bit overlap, normalised between what chance gives and the most possible, of each filter of the shorter chain
with its best partner, weighted by features.

Documents are dealt to buckets of neighbouring ids, each a partition of its own, so the next document in id order is the next
row of a sorted stream; only the first document of each bucket is sent twice. Rows that share an id, or have none,
are cut into buckets by a hash of their text where they are many.

Defined cases: null text is the empty text; the empty text has the empty fingerprint, unlike every other and
equal to itself; rows with the same id follow each other by a hash of their text, then by text, rows without an id come
last, in that order as well; a single row is its own next document; repeated rows keep one result row each; texts of any length
are read whole; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, table, text_or_empty

WINDOW, STRETCH, POINTS = 16, 32, 12
SHORT, TINY, TINY_WINDOW = 512, 64, 4
BITS, SUB_HASHES, PER_FILTER = 2048, 5, 160
CLASSES = 1025  # entropy of a window in 1/256 bit
SEGMENT = 1 << 17  # bytes handled at once; longer texts are cut into overlapping segments
BUCKET_ROWS, MOST_BUCKETS = 4096, 50_000  # granularity of the id buckets; rows are never dropped

_UNIT = 14  # sums of n log n are kept in units of 2 ** -14
_SHIFT = 6  # and looked up in steps of 2 ** -8
_N_LOG_N = np.array([0] + [round(k * np.log2(k) * (1 << _UNIT)) for k in range(1, WINDOW + 1)], np.int32)
_GAIN = _N_LOG_N[1:] - _N_LOG_N[:-1]
_STEPS = np.arange((int(_N_LOG_N[-1]) >> _SHIFT) + 2) / (1 << (_UNIT - _SHIFT))
_CLASS_OF = np.clip(np.round((np.log2(WINDOW) - _STEPS / WINDOW) * 256), 0, 1024).astype(np.int32)


def entropy_classes(x: np.ndarray) -> np.ndarray:
    """Entropy class of every window of ``WINDOW`` bytes of ``x``, by sliding updates of sum n log n."""
    n = len(x)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    order = np.argsort(x, kind="stable").astype(np.int32)
    key = order + (x[order].astype(np.int32) << 22)  # a buffer is shorter than 1 << 22
    before, after = np.zeros(n, np.int8), np.zeros(n, np.int8)  # equal bytes among the WINDOW-1 on either side
    idx = np.flatnonzero(key[1:] - key[:-1] < WINDOW).astype(np.int32) + 1
    k = 1
    while len(idx):
        before[idx] += 1
        after[idx - k] += 1
        k += 1
        idx = idx[idx >= k] if len(idx) and idx[0] < k else idx
        idx = idx[key[idx] - key[idx - k] < WINDOW]
    by_place = np.empty(n, np.int8)
    by_place[order] = before
    gain = _GAIN[by_place[WINDOW:]]
    by_place[order] = after
    gain -= _GAIN[by_place[:n - WINDOW]]
    total = np.empty(n - WINDOW + 1, np.int32)
    total[0] = _N_LOG_N[np.bincount(x[:WINDOW], minlength=256)].sum()
    np.cumsum(gain, out=total[1:])
    total[1:] += total[0]
    return _CLASS_OF[total >> _SHIFT]


def _hashes(x: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the windows of ``width`` bytes at ``at``; ``x`` reaches ``width`` beyond each."""
    rows = np.zeros((len(at), 16), np.uint8)
    rows[:, :width] = x[at[:, None] + np.arange(width)]
    a, b = rows.view("<u8").T
    with np.errstate(over="ignore"):
        h = a * np.uint64(0x9E3779B97F4A7C15) + np.uint64(width)
        h ^= h >> np.uint64(29)
        h = (h + b) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _segments(texts: list[bytes], least: int = SHORT) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """Groups of (text, from, to, first own window, end of own windows) of about ``SEGMENT`` bytes, of the texts of
    ``least`` bytes and more."""
    group, size, margin = [], 0, WINDOW + STRETCH
    for i, t in enumerate(texts):
        if len(t) < least:
            continue
        for a in range(0, len(t), SEGMENT):
            lo, hi = max(0, a - margin), min(len(t), a + SEGMENT + margin)
            group.append((i, lo, hi, a, min(a + SEGMENT, len(t))))
            size += hi - lo
            if size >= SEGMENT:
                yield group
                group, size = [], 0
    if group:
        yield group


def features(texts: list[bytes], rarity: np.ndarray) -> list[np.ndarray]:
    """Hashes of the features of every text, in text order."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for group in _segments(texts):
        x = np.frombuffer(b"".join(texts[i][lo:hi] for i, lo, hi, _, _ in group), np.uint8)
        key = (rarity[entropy_classes(x)] << 20).astype(np.int32) | np.arange(len(x) - WINDOW + 1, dtype=np.int32)
        low, span = key, 1
        while span < STRETCH:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        start, last = 0, []
        points = np.zeros(len(key), np.int32)
        for i, lo, hi, _, _ in group:
            windows = hi - lo - WINDOW + 1
            best = low[start:start + windows - STRETCH + 1] & 0xFFFFF
            points[start:start + windows] = np.bincount(best - start, minlength=windows)
            last.append((i, lo, start, windows))
            start += hi - lo
        for (i, lo, hi, own, end), (_, _, start, windows) in zip(group, last):
            at = start + np.flatnonzero(points[start:start + windows] >= POINTS)
            at = at[(at - start + lo >= own) & (at - start + lo < end)]
            found[i].append(_hashes(x, at, WINDOW))
    out = []
    for t, parts in zip(texts, found):
        if len(t) >= SHORT:
            h = np.concatenate(parts)
        else:
            width = WINDOW if len(t) >= TINY else TINY_WINDOW
            x = np.frombuffer(t, np.uint8)
            if 0 < len(t) < width:
                x = np.concatenate([x, np.zeros(width - len(t), np.uint8)])
            h = _hashes(x, np.arange(max(0, len(x) - width + 1)), width)
        _, first = np.unique(h, return_index=True)
        out.append(h[np.sort(first)])
    return out


def filters(h: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters of a feature list, as bytes (filters, BITS / 8)."""
    chain = np.zeros((-(-len(h) // PER_FILTER), BITS), np.uint8)
    row = np.arange(len(h)) // PER_FILTER
    for k in range(SUB_HASHES):
        chain[row, (h >> np.uint64(11 * k)).astype(np.int64) & (BITS - 1)] = 1
    return np.packbits(chain, axis=1)


def encode(h: np.ndarray) -> str:
    """``features:filters in base64``; empty for no features."""
    return f"{len(h)}:" + base64.b64encode(filters(h).tobytes()).decode() if len(h) else ""


def decode(fingerprint: str) -> tuple[int, np.ndarray]:
    n, _, body = fingerprint.partition(":")
    packed = np.frombuffer(base64.b64decode(body), np.uint8).reshape(-1, BITS // 8)
    return int(n or 0), np.unpackbits(packed, axis=1).astype(np.float32)


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (na, fa), (nb, fb) = decode(a), decode(b)
    if (len(fa), na) > (len(fb), nb):
        na, fa, nb, fb = nb, fb, na, fa
    sa, sb = fa.sum(1)[:, None], fb.sum(1)[None, :]
    most, chance = np.minimum(sa, sb), sa * sb / BITS
    overlap = np.clip((fa @ fb.T - chance) / np.maximum(most - chance, 1e-9), 0, 1).max(1)
    weight = np.minimum(PER_FILTER, na - PER_FILTER * np.arange(len(fa)))
    return float((overlap * weight).sum() / weight.sum())


def rarity_table(docs: DataFrame) -> np.ndarray:
    """Rank of every entropy class, rarest first, from all windows of all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for b in batches:
            texts = [t.as_py() for t in b.column(0)]
            for group in _segments(texts, WINDOW):
                for i, lo, hi, own, end in group:
                    c = entropy_classes(np.frombuffer(texts[i], np.uint8)[lo:hi])
                    total += np.bincount(c[own - lo:end - lo], minlength=CLASSES)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["class", "n"])

    counts = map_batches(docs.select(text_or_empty().cast("binary").alias("text")), count, "class int, n bigint")
    total = np.zeros(CLASSES, np.int64)
    for row in counts.groupBy("class").agg(F.sum("n").alias("n")).collect():  # at most CLASSES rows
        total[row["class"]] = row["n"]
    rank = np.empty(CLASSES, np.int64)
    rank[np.lexsort((np.arange(CLASSES), total))] = np.arange(CLASSES)
    return rank


def fingerprints(docs: DataFrame, rarity: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, fingerprint)``."""
    rank = docs.sparkSession.sparkContext.broadcast(rarity_table(docs) if rarity is None else rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([encode(h) for h in features(texts, rank.value)], pa.string())], ["doc_id", "fingerprint"])

    return map_batches(docs.select("doc_id", text_or_empty().cast("binary").alias("text")), run, "doc_id bigint, fingerprint string")


class Buckets:
    """Buckets of neighbouring documents by descending id, then ascending hash of the text; rows without an id come last.

    ``cuts``: ids at equal distances of rank. One that occurs ``m`` times among them has about as many buckets' worth of rows:
    it gets ``m`` buckets of its own, by hash. Rows without an id get ``nulls`` buckets.
    """

    def __init__(self, cuts: list[int], nulls: int):
        times = Counter(cuts)
        self.ends = np.array(sorted(times), np.int64)
        self.parts = np.array([times[c] if times[c] > 1 else 0 for c in self.ends.tolist()], np.int64)  # buckets of that id alone
        widths = np.concatenate([[1], self.parts[::-1] + 1])  # by descending id, first the ids above the last cut
        self.offset = np.cumsum(widths) - widths
        self.first_null, self.nulls = int(widths.sum()), max(1, nulls)
        self.count = self.first_null + self.nulls

    def of(self, ids: pd.Series, hashes: pd.Series) -> np.ndarray:
        missing = ids.isna().to_numpy(bool)
        i, h = ids.fillna(0).to_numpy(np.int64), (hashes.to_numpy(np.int64) >> 32) + (1 << 31)
        at = np.searchsorted(self.ends, i, "left")  # the cut at or above the id
        out = self.offset[len(self.ends) - at]
        if len(self.ends):
            cut = np.minimum(at, len(self.ends) - 1)
            parts = np.where(at < len(self.ends), self.parts[cut], 0)
            out = out + np.where((parts > 0) & (self.ends[cut] == i), (h * parts) >> 32, parts)
        return np.where(missing, self.first_null + ((h * self.nulls) >> 32), out)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows ``(bucket, tail, doc_id, text)`` partitioned by bucket and sorted so that the row after each is the
    next document in descending id order; a bucket ends with the first row (``tail``) of the bucket after it."""
    rows = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("hash"))
    total = docs.agg(F.count("*").alias("n"), F.count("doc_id").alias("named")).first()
    wanted = max(1, min(MOST_BUCKETS, total["named"] // BUCKET_ROWS))
    cuts: list[int] = []
    if wanted > 1:
        probs = [k / wanted for k in range(1, wanted)]
        cuts = docs.select(F.percentile_approx("doc_id", probs, max(10_000, 10 * wanted)).alias("q")).first()["q"] or []
    buckets = Buckets(cuts, min(MOST_BUCKETS, (total["n"] - total["named"]) // BUCKET_ROWS))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(buckets.of(ids.astype("Int64"), hashes))

    # the first row of every bucket: the largest id, then the smallest hash
    placed = rows.select("doc_id", "hash", bucket_of("doc_id", "hash").alias("bucket"))
    heads = placed.groupBy("bucket").agg(F.min(F.struct((-F.col("doc_id")).alias("i"), "hash")).alias("h")).orderBy("bucket").collect()  # one row per bucket
    at = [h["bucket"] for h in heads]
    previous = {b: at[k - 1] for k, b in enumerate(at)}
    first_of = {h["bucket"]: (None if h["h"]["i"] is None else -h["h"]["i"], h["h"]["hash"]) for h in heads}

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        ids = ids.astype("Int64")
        out = []
        for i, h, b in zip(ids, hashes, buckets.of(ids, hashes).tolist()):
            i = None if pd.isna(i) else int(i)
            out.append([2 * b] + ([2 * previous[b] + 1] if first_of[b] == (i, h) else []))
        return pd.Series(out)

    placed = rows.select("doc_id", "text", "hash", F.explode(places("doc_id", "hash")).alias("place")).select(
        F.expr("place div 2").alias("bucket"), (F.col("place") % 2 == 1).alias("tail"), "doc_id", "text", "hash")
    return (placed.repartitionById(buckets.count, F.col("bucket").cast("int"))
            .sortWithinPartitions("bucket", "tail", F.col("doc_id").desc_nulls_last(), "hash", "text").drop("hash"))


def neighbours(docs: DataFrame, rarity: np.ndarray | None = None) -> DataFrame:
    """Fingerprints of every text, its edited text and their likeness (see ``op5_fingerprint``)."""
    rank = docs.sparkSession.sparkContext.broadcast(rarity_table(docs) if rarity is None else rarity)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple[int, str, str, bool]] = []  # id, text, next text, whether the next pair begins with it
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal size
            own = [p[1] for p in pairs]
            edited = [t[:len(t) - len(t) // 3] + nxt[:len(t) // 3] for _, t, nxt, _ in pairs]
            lone = [k for k, p in enumerate(pairs) if not (k + 1 < len(pairs) and p[3])]  # next texts not in ``own``
            texts = own + edited + [pairs[k][2] for k in lone]
            prints = [encode(h) for h in features([t.encode("utf-8", "replace") for t in texts], rank.value)]
            of_own, of_edited = prints[:len(pairs)], prints[len(pairs):2 * len(pairs)]
            of_next = of_own[1:] + [""]
            for k, p in zip(lone, prints[2 * len(pairs):]):
                of_next[k] = p
            rows = [(p[0], len(p[1]), sha256(e.encode("utf-8", "replace")).hexdigest(), a, b, likeness(a, b), likeness(a, c))
                    for p, e, a, b, c in zip(pairs, edited, of_own, of_edited, of_next)]
            pairs.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        pending, current, ended = None, None, False
        for b in batches:
            for bucket, tail, doc_id, text in zip(*(b.column(k).to_pylist() for k in range(4))):
                if bucket != current:
                    pending, current, ended = None, bucket, False
                if ended:
                    continue
                if pending is not None:
                    pairs.append((*pending, text, not tail))
                    size += len(pending[1]) + len(text)
                    if size >= SEGMENT:
                        yield flush()
                pending, ended = (doc_id, text), tail
        if pairs:
            yield flush()

    return map_batches(with_next(docs), run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                       "edited_fingerprint string, near_edited double, near_next double")


def op5_fingerprint(spark, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "documents"))

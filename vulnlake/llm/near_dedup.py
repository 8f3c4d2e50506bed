"""MinHash near-dedup, candidates verified with odd sketches and then on the full shingle sets.

1. Every whole text becomes its set of ``SHINGLE``-word shingles (64-bit hashes). Equal sets are one node, named
   by the smallest id among them, so copies never meet as pairs.
2. ``BANDS * ROWS`` MinHash samples per node form the bands. The samples are also folded into an odd sketch, a
   parity bitmap of ``SKETCH_BITS`` bits. A pair at similarity 0.8 shares no band with probability
   ``(1 - 0.8**ROWS)**BANDS`` (5e-7 for the defaults).
3. In every band bucket all members are linked to one centre (never to each other): the XOR population count
   of two odd sketches estimates the similarity, and only pairs far below the threshold are dropped (six
   standard errors); the rest are compared on their full sets.
4. Connected components are taken. Where a bucket still holds several components, another centre is chosen;
   after ``ROUNDS`` rounds all documents of the open buckets are compared, in blocks. No pair that could join
   two components is left out, and nothing caps a bucket.

Bucket centres come from a map-side combined minimum that is joined back, so a bucket that holds a third of
all nodes is spread over tasks and adaptive execution can split it.

Defined cases: null and empty texts have an empty set and stand alone; fewer words than a shingle are one
shingle; rows that share an id are one document (their texts' links are shared); a row without an id stands
alone, with a null component, and is kept; texts of any length give their whole set (sampled in pieces, held once per task); an
empty table gives an empty result; other columns are ignored (by ``keep_one_each``: kept), whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_words, components, distinct_words, groups, map_batches, slices, stored, table, text_or_empty

SHINGLE, PERCENT = 4, 80
BANDS, ROWS = 48, 6
SKETCH_BITS = 1024
ROUNDS = 2  # rounds of centres before what is open is compared in blocks
BLOCK_DOCS, BLOCK_BYTES = 512, 8 << 20  # documents and bytes of shingle hashes of a block
_SEED = 20240117

_rng = np.random.default_rng(_SEED)
_MULT = _rng.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_PIECE = 4096  # shingles sampled at once
_CELLS = 1 << 15  # their samples that are computed at once, about
GROUP = 2 << 20  # bytes of texts whose words are mixed at once


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        return h


def _word_hashes(words: list[bytes]) -> np.ndarray:
    hashed = hashlib.blake2b
    return np.frombuffer(b"".join([hashed(w, digest_size=8).digest() for w in words]), "<u8")


def _shingles(h: np.ndarray, words: int) -> np.ndarray:
    """Hashes of all runs of ``words`` word hashes."""
    n = len(h) - words + 1
    out = np.full(n, words, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += h[k:k + n]
            out = _mix(out)
    return out


def sets_of(texts: pa.Array, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a binary array. In groups of about ``GROUP`` bytes words are split,
    the distinct ones hashed, and all mixed as arrays."""
    out = []
    for i, j in groups(pc.binary_length(texts).to_pylist(), GROUP):
        words, places, begin = distinct_words(texts[i:j], lower=True)  # lower-cases A-Z only, splits at x20 and x09-x0D
        h = _word_hashes(as_words(words))[places]
        full = _shingles(h, width) if len(h) >= width else None  # the runs that cross from text to text are not read
        for a, z in zip(begin[:-1].tolist(), begin[1:].tolist()):
            s = full[a:z - width + 1] if z - a >= width else _shingles(h[a:z], z - a) if z > a else np.zeros(0, np.uint64)
            s = np.sort(s)
            same = s[1:] == s[:-1]
            out.append(s[np.append(True, ~same)] if same.any() else s)
    return out


def samples(shingles: np.ndarray) -> np.ndarray:
    """``BANDS * ROWS`` MinHash samples (uint32) of a non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    best = np.full(len(_MULT), 0xFFFFFFFF, np.uint32)
    step = max(16, _CELLS // min(len(x), _PIECE))
    h, shifted = (np.empty((step, min(len(x), _PIECE)), np.uint32) for _ in range(2))
    with np.errstate(over="ignore"):
        for i in range(0, len(x), _PIECE):
            part = x[i:i + _PIECE]
            for j in range(0, len(_MULT), step):
                mult = _MULT[j:j + step, None]
                a, b = h[:len(mult), :len(part)], shifted[:len(mult), :len(part)]
                np.multiply(part[None, :], mult, out=a)
                a += _ADD[j:j + step, None]
                np.right_shift(a, np.uint32(15), out=b)
                a ^= b
                a *= np.uint32(0x2C1B3C6D)
                np.right_shift(a, np.uint32(13), out=b)
                a ^= b
                np.minimum(best[j:j + step], a.min(1), out=best[j:j + step])
    return best


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, for each row of samples; the band's number is part of it."""
    rows = minima.reshape(*minima.shape[:-1], BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:-1])
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[..., k])
    return key.view(np.int64)


def odd_sketch(minima: np.ndarray) -> np.ndarray:
    """Parity bitmap of the (sample number, sample) pairs, as int64 words, for each row of samples."""
    rows = minima.reshape(-1, minima.shape[-1])
    with np.errstate(over="ignore"):
        at = _mix(np.arange(rows.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + rows) % np.uint64(SKETCH_BITS)
    at = at.astype(np.int64) + np.arange(len(rows))[:, None] * SKETCH_BITS
    bits = (np.bincount(at.ravel(), minlength=len(rows) * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64).reshape(*minima.shape[:-1], -1)


def most_odd_bits(percent: int = PERCENT) -> int:
    """XOR population count that a pair at the threshold exceeds by chance less than once in a billion: the
    samples that differ number ``k(1-J)`` and six standard errors more; each puts two elements into the
    symmetric difference, and the bitmap's expectation and six standard errors bound the count."""
    k, j = BANDS * ROWS, percent / 100
    differ = k * (1 - j) + 6 * (k * j * (1 - j)) ** 0.5
    expected = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * differ))
    return int(expected + 6 * (SKETCH_BITS / 4) ** 0.5 * (1 - (1 - 2 / SKETCH_BITS) ** (4 * differ)) ** 0.5) + 1


def sketches(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, n, digest, bands, sketch)``; digest names the shingle set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        for b in slices(batches):
            got = sets_of(b.column(1))
            digest = [hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in got]
            if len(seen) > 10_000:
                seen.clear()
            new = {key: s for key, s in zip(digest, got) if key is not None and key not in seen}
            if new:
                minima = np.stack(list(map(samples, new.values())))
                seen.update(zip(new, zip(band_keys(minima), odd_sketch(minima))))
            n, bands, sketch = map(len, got), *([seen[key][k] if key is not None else None for key in digest] for k in range(2))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(sketch, pa.list_(pa.int64()))], ["doc_id", "n", "digest", "bands", "sketch"])

    return map_batches(docs.select("doc_id", text_or_empty().cast("binary").alias("text")), run,
                       "doc_id bigint, n bigint, digest binary, bands array<bigint>, sketch array<bigint>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``(id, text)`` -> ``(id, n, shingles)``, the set as packed 64-bit hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = sets_of(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(map(len, got), pa.int64()), pa.array([s.tobytes() for s in got], pa.binary())], ["id", "n", "shingles"])

    return map_batches(docs.select("id", "text"), run, "id bigint, n bigint, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets meet the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both_n = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both_n >= percent * (len(x) + len(y) - both_n))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return map_batches(both, run, "a bigint, b bigint").distinct()


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``pairs(a, b)`` less those whose odd sketches rule the threshold out."""
    left = nodes.select(F.col("id").alias("a"), F.col("sketch").alias("ka"))
    right = nodes.select(F.col("id").alias("b"), F.col("sketch").alias("kb"))
    odd = F.aggregate(F.zip_with("ka", "kb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
    return pairs.join(left, "a").join(right, "b").where(odd <= most_odd_bits()).select("a", "b").distinct()


def _centre_pairs(still: DataFrame, step: int) -> DataFrame:
    """One centre per bucket, another one in each round, with every member of another component."""
    order = F.xxhash64("id", F.lit(step)) if step else F.col("id")
    centres = still.groupBy("key").agg(F.min(F.struct(order.alias("o"), "id", "component")).alias("c"))
    return still.join(centres, "key").where(F.col("component") != F.col("c")["component"]).select(
        F.col("c")["id"].alias("a"), F.col("id").alias("b")).distinct()


def _block_links(still: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links between the components of buckets that hold several, ``still(key, id, component)``.

    Documents that buckets connect are a family. A family is dealt into blocks of bounded size, every two blocks
    meet in one group, and there an inverted index of the second block's shingles counts what each document of
    the first has in common with all of it. A group returns one link for any two components it finds linked.
    """
    stars = still.join(still.groupBy("key").agg(F.min("id").alias("a")), "key").select("a", F.col("id").alias("b")).distinct()
    family = components(stars, "near-families").withColumnRenamed("component", "family")
    nodes = stored(still.select("id", "component").distinct().join(family, "id").join(sets, "id"), "near-open-nodes")
    sizes = nodes.groupBy("family").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_DOCS, F.sum(F.octet_length("shingles")) / BLOCK_BYTES)).cast("bigint").alias("blocks"))
    mine = F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = (nodes.join(sizes, "family").withColumn("block", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
             .select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "component", "shingles")
             .repartition("family", "i", "j").sortWithinPartitions("family", "i", "j"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def links() -> list[tuple[int, int]]:
            first = [x for x in held if x[3] == x[1]]
            second = [x for x in held if x[3] == x[2]]
            if not first or not second:
                return []
            arrays = [np.frombuffer(x[6], np.uint64) for x in second]
            size = np.array([len(x) for x in arrays])
            shingle = np.concatenate(arrays)
            order = np.argsort(shingle, kind="stable")
            owner = np.repeat(np.arange(len(arrays)), size)[order]
            shingle, begin = np.unique(shingle[order], return_index=True)
            end = np.append(begin[1:], len(owner))
            found: dict[tuple[int, int], tuple[int, int]] = {}
            for x in first:
                own = np.frombuffer(x[6], np.uint64)
                at = np.searchsorted(shingle, own)
                at = at[(at < len(shingle)) & (shingle[np.minimum(at, len(shingle) - 1)] == own)]
                lengths = end[at] - begin[at]
                places = np.repeat(begin[at] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
                both_n = np.bincount(owner[places], minlength=len(arrays))
                for k in np.flatnonzero(100 * both_n >= percent * (len(own) + size - both_n)):
                    y = second[k]
                    if x[5] != y[5]:
                        found.setdefault((min(x[5], y[5]), max(x[5], y[5])), (min(x[4], y[4]), max(x[4], y[4])))
            return list(found.values())

        def batch(pairs) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

        for b in slices(batches):
            for x in zip(*(b.column(k).to_pylist() for k in range(7))):
                if x[:3] != current:
                    if held:
                        yield batch(links())
                    current, held = x[:3], []
                held.append(x)
        if held:
            yield batch(links())

    return map_batches(dealt, run, "a bigint, b bigint").distinct()


def link(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(sketch rows, sets (digest, id), components (id, component))`` of ``docs(doc_id, text)``; ids without
    links have no component."""
    rows = stored(sketches(docs), "near-sketches")
    named = rows.where("doc_id is not null and digest is not null")
    first = stored(named.groupBy("digest").agg(F.min("doc_id").alias("id")), "near-first")
    # the sets of an id with several texts are linked by the id
    nodes_of = named.select("digest", "doc_id").distinct().join(first, "digest").select("doc_id", "id")
    several = nodes_of.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("doc_id", "a")
    links = stored(nodes_of.join(several, "doc_id").where("a < id").select("a", F.col("id").alias("b")).distinct(), "near-same-id")
    # a set is stood for by the row of its smallest id; an id may stand for several sets, with several sketches
    nodes = named.join(first, "digest").where("doc_id = id")
    members = nodes.select("id", F.explode("bands").alias("key")).distinct()
    crowded = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = stored(members.join(crowded, "key"), "near-buckets")
    wanted = stored(members.select("id").distinct(), "near-wanted")
    texts = docs.select(F.col("doc_id").alias("id"), text_or_empty().cast("binary").alias("text"))
    sets = stored(shingle_sets(texts.join(wanted, "id", "left_semi")).where("n > 0").distinct(), "near-sets")
    marks = stored(nodes.select("id", "sketch").join(wanted, "id", "left_semi"), "near-marks")
    if wanted.isEmpty():
        return rows, first, components(links, "near-components")

    still = members.withColumn("component", F.col("id"))
    for step in range(ROUNDS + 1):
        if step < ROUNDS:
            new = verified(_likely(_centre_pairs(still, step), marks), sets)
        else:
            new = _block_links(still, sets)
        links = links.unionByName(stored(new, "near-links"))
        found = components(links, "near-components")
        if step == ROUNDS:
            break
        placed = stored(members.join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")), "near-placed")
        parts = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        still = stored(placed.join(parts.where("low < high").select("key"), "key"), "near-open")
        if still.isEmpty():
            break
    return rows, first, found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows, first, found = link(docs)
    named = first.join(found, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of every component the document with the smallest id stays,
    and of several rows with that id the one with the smallest text. Rows without an id stay."""
    found = near_duplicates(docs)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    dropped = found.where("not kept").select("doc_id")
    leave = stored(dropped.unionByName(repeated).distinct(), "near-dropped")
    several = stored(repeated.join(dropped, "doc_id", "left_anti"), "near-repeated")
    once = (docs.join(several, "doc_id", "left_semi")
            .groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("r")).select("r.*"))
    return docs.join(leave, "doc_id", "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))


def op4_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

"""LM scoring by cross-entropy difference over words.

Two word trigram models of the same smoothing and one vocabulary: the target model counts the documents marked as
target, the background model counts all documents. Tokens are runs of word characters, single characters of scripts written
without spaces, and single marks; white space only separates. A document's score is the mean, over its tokens, of
background loss minus target loss, in bits: above zero, it reads more like the target.

    P1(w) = (count(w) + 1) / (tokens + words)        P2(w | v) = (count(v w) + K P1(w)) / (count(v) + K)
    P3(w | u v) = (count(u v w) + K P2(w | v)) / (count(u v) + K)

``words`` is the number of distinct words of all documents in both models, so they spread what they have not seen over the same
vocabulary. A document starts with two marks, as context only, and ends with one, which counts as a word. A context's
count is the count of that shorter n-gram, so counts of n-grams are all that is needed.

1. Documents are stored where they lie, in blocks of about ``BLOCK`` characters, in a table bucketed by block: no text is shuffled.
2. Every block counts its distinct n-grams of one to three words and asks the buckets they belong to (leading bits of their
   hash) how often they occur in the whole corpus. A question is a sorted list: differences of less than five bytes each, and small counts.
3. A bucket adds up what all blocks sent and answers each in the order of its question.
4. A block scores its documents with the answers. No model is broadcast or held by one process, nothing is pruned: what
   is counted grows with the corpus. A frequent n-gram is one entry per block, so none is hot.

N-grams are known by 54 bits of a hash and their order. Defined cases: null and empty texts, and those of white space only, have no tokens,
losses of null and a score of 0; without target documents the target model is uniform over the vocabulary; repeated rows
count as often as they occur, a null id is never a target; a text longer than a block is a block of its own and is read whole, in
pieces; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import map_batches, stored, table, text_or_empty
from .quality import held_out

ORDER = 3
K = 4.0
BITS = 56  # of a key: 54 of the hash, 2 for the order
BLOCK = 1 << 23  # characters
PER_BUCKET = 1 << 24  # characters of the corpus for each bucket
PER_TASK = 1 << 26  # characters of blocks that one task works off, one after the other
MOST_TASKS = 100_000  # as many buckets a table may have
PIECE = 1 << 20  # characters hashed at once
START, END = np.uint64(1), np.uint64(2)  # marks around a document; hashes of words are larger
_ALONE = "฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
TOKEN = re.compile(rf"[{_ALONE}]|[^\W{_ALONE}]+|[^\w\s]")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every code point's class (0 separates, 1 goes on, 2 stands alone), and the powers of the base and its inverse."""
    points = "".join(map(chr, [*range(0xD800), *([0x20] * 0x800), *range(0xE000, 0x110000)]))
    kind = np.zeros(0x110000, np.uint8)
    for m in re.finditer(rf"[^\w\s]+|[{_ALONE}]+", points):
        kind[m.start():m.end()] = 2
    for m in re.finditer(rf"[^\W{_ALONE}]+", points):
        kind[m.start():m.end()] = 1
    kind[0xD800:0xE000] = 2  # no text has them; as the marks they would be
    powers = []
    for base in (_BASE, _INVERSE):
        p = np.full(2 * PIECE, base, np.uint64)
        p[0] = 1
        powers.append(np.multiply.accumulate(p))
    return kind, *powers


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def token_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every token of the text, larger than the marks."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kinds, up, down = _tables()
    out, at = [], 0
    while at < len(codes):
        end = min(at + PIECE, len(codes))
        kind = kinds[codes[at:end]]
        while end < len(codes) and kind[-1] == 1 and kinds[codes[end]] == 1:  # a word goes on: take all of it
            more = kinds[codes[end:end + PIECE]]
            stop = int(np.argmax(more != 1)) if (more != 1).any() else len(more)
            kind, end = np.concatenate([kind, more[:stop]]), end + stop
        own = codes[at:end].astype(np.uint64) + np.uint64(1)
        word = kind == 1
        first = (kind == 2) | (word & np.concatenate([[True], kind[:-1] != 1]))
        last = (kind == 2) | (word & np.concatenate([kind[1:] != 1, [True]]))
        a, z = np.flatnonzero(first), np.flatnonzero(last)
        if len(own) > len(up):  # one word beyond two pieces
            power = np.full(len(own), _BASE, np.uint64), np.full(len(own), _INVERSE, np.uint64)
            for p in power:
                p[0] = 1
            up_, down_ = (np.multiply.accumulate(p) for p in power)
        else:
            up_, down_ = up, down
        total = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(own * up_[:len(own)])])
        out.append(_mixed((total[z + 1] - total[a]) * down_[a] + (z + 1 - a).astype(np.uint64)) | np.uint64(4))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Grams:
    """The n-grams at every token of some documents. ``keys[k - 1]`` has the n-gram of k words that ends at each place of
    the documents strung together; ``scored`` are the places of words, ``doc`` their documents, ``counted[k - 1]`` what counts."""

    def __init__(self, texts: list[np.ndarray]):
        parts, kinds = [], []
        for t in texts:
            if len(t):
                parts += [[START, START], t, [END]]
                kinds += [[0, 1], np.full(len(t), 3, np.uint8), [2]]
        s = np.concatenate([np.zeros(0, np.uint64), *(np.asarray(p, np.uint64) for p in parts)])
        kind = np.concatenate([np.zeros(0, np.uint8), *(np.asarray(p, np.uint8) for p in kinds)])
        self.scored = np.flatnonzero(kind == 3)
        self.doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        self.place_doc = np.repeat(np.arange(len(texts)), [len(t) + 3 if len(t) else 0 for t in texts])
        # marks at the start count as contexts: one word or two, never three
        self.counted = [kind >= 1, kind >= 1, kind >= 2]
        before = np.concatenate([[START], s[:-1]]) if len(s) else s
        before2 = np.concatenate([[START, START], s[:-2]])[:len(s)] if len(s) else s
        two = _mixed(before * np.uint64(_BASE) + s)
        three = _mixed(_mixed(before2 * np.uint64(_BASE) + before) * np.uint64(0xD6E8FEB86659FD93) + s)
        self.keys = [((h >> np.uint64(64 - BITS + 2)) << np.uint64(2) | np.uint64(k + 1)).astype(np.int64) for k, h in enumerate((_mixed(s), two, three))]

    def numbers(self) -> list[np.ndarray]:
        """For every order, the rank of each counted place's n-gram among the distinct ones of all orders."""
        keys = self.all_keys()
        by = np.argsort(keys)
        rank = np.empty(len(keys), np.int32)
        rank[by] = np.cumsum(np.diff(keys[by], prepend=-1) != 0, dtype=np.int32) - 1
        out, at = [], 0
        for c in self.counted:
            n = int(c.sum())
            out.append(np.zeros(len(c), np.int32))
            out[-1][c] = rank[at:at + n]
            at += n
        return out

    def all_keys(self, places: np.ndarray | None = None) -> np.ndarray:
        return np.concatenate([x[c if places is None else c & places] for x, c in zip(self.keys, self.counted)])


def _squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _spread(b: bytes) -> bytes:
    return pa.decompress(b[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences: their lowest bytes, then the next ones, and so on; the high ones compress."""
    d = np.diff(keys, prepend=0).astype("<i8")
    size = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    return bytes([size]) + _squeeze(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes())


def _unpack_keys(b: bytes) -> np.ndarray:
    raw = np.frombuffer(_spread(b[1:]), np.uint8).reshape(b[0], -1)
    d = np.zeros((raw.shape[1], 8), np.uint8)
    d[:, :b[0]] = raw.T
    return np.cumsum(d.reshape(-1).view("<i8"))


def _pack(a: np.ndarray) -> bytes:
    """Counts: a byte each; 255 stands for the next of the larger ones, which follow."""
    big = a >= 255
    return len(a).to_bytes(8, "little") + _squeeze(np.where(big, 255, a).astype(np.uint8).tobytes() + a[big].astype("<i8").tobytes())


def _unpack(b: bytes) -> np.ndarray:
    n, raw = int.from_bytes(b[:8], "little"), _spread(b[8:])
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, "<i8", offset=n)
    return out


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in schema.split(", "))])
    cols = zip(*rows) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, fields)], schema=fields)


def store_blocks(docs: DataFrame, size: int) -> DataFrame:
    """``(block, row, doc_id, text)`` in a table bucketed by block; row is the number within the block. ``size``: characters in
    all; the table has a bucket, which is one task's work, for every ``PER_TASK`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size, block, row = TaskContext.get().partitionId() << 32, 0, 0, 0
        for b in batches:
            blocks, rows = [], []
            for text in b.column(1):
                n = len(text.as_py())
                if size and size + n > BLOCK:
                    size, block, row = 0, block + 1, 0
                blocks.append(part + block)
                rows.append(row)
                size, row = size + n, row + 1
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(rows, pa.int32()), *b.columns], ["block", "row", "doc_id", "text"])

    spark, name = docs.sparkSession, f"lm_blocks_{uuid.uuid4().hex[:12]}"
    rows = map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")), run,
                       "block bigint, row int, doc_id bigint, text string")
    tasks = min(MOST_TASKS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PER_TASK + 1))
    (rows.write.option("compression", "zstd").bucketBy(tasks, "block")
     .option("path", scratch_path(spark, name)).format("parquet").saveAsTable(name))
    return spark.table(name)


def target_rows(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """Stored ``(block, row)`` of the documents listed in ``targets(doc_id)``."""
    marked = targets.select("doc_id").where("doc_id is not null").distinct()
    return stored(blocks.select("block", "row", "doc_id").join(marked, "doc_id", "left_semi").select("block", "row"), "lm-targets")


def _read(rows: pa.Table, marked: list[int]) -> tuple[list, np.ndarray, Grams]:
    rows = rows.sort_by("row")
    target = np.isin(rows.column("row").to_numpy(), np.array(marked, np.int64))
    return rows.column("doc_id").to_pylist(), target, Grams([token_hashes(t.as_py()) for t in rows.column("text")])


ASKED = "bucket int, block bigint, keys binary, n binary, m binary"
ANSWERED = "block bigint, bucket int, n binary, m binary, words bigint, tokens bigint, target_tokens bigint"
SCORED = "doc_id bigint, target boolean, n_tokens bigint, loss_target double, loss_background double, score double"


def questions(blocks: DataFrame, targets: DataFrame, bucket_bits: int) -> DataFrame:
    """What every block asks of every bucket: its n-grams there, with their counts in all and in target documents."""
    def run(rows: pa.Table, marked: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _table([], ASKED)
        _, target, grams = _read(rows, marked.column("row").to_pylist())
        keys, n = np.unique(grams.all_keys(), return_counts=True)
        m = np.zeros(len(keys), np.int64)
        if target.any():
            own, count = np.unique(grams.all_keys(target[grams.place_doc]), return_counts=True)
            m[np.searchsorted(keys, own)] = count
        bucket = keys >> (BITS - bucket_bits)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
        block = rows.column("block")[0].as_py()
        return _table([(int(bucket[a]), block, _pack_keys(keys[a:z] & ((1 << (BITS - bucket_bits)) - 1)), _pack(n[a:z]), _pack(m[a:z]))
                       for a, z in zip(starts, [*starts[1:], len(keys)])], ASKED)

    return (blocks.select("block", "row", "doc_id", "text").groupBy("block")
            .cogroup(targets.groupBy("block")).applyInArrow(run, ASKED))


def answers(asked: DataFrame, shift: int) -> DataFrame:
    """Stored: the counts of the whole corpus for what was asked, in the order of the question; the first answer of a bucket
    carries how many distinct words it has and how often they occur. ``shift``: bits of a key behind the bucket's."""
    start_key = int(_mixed(np.array([START]))[0] >> np.uint64(64 - BITS + 2)) << 2 | 1

    def run(rows: pa.Table) -> pa.Table:
        sent = [_unpack_keys(b.as_py()) for b in rows.column("keys")]
        u, inverse = np.unique(np.concatenate(sent), return_inverse=True)
        n, m = (np.bincount(inverse, np.concatenate([_unpack(b.as_py()) for b in rows.column(c)]), len(u)).astype(np.int64) for c in ("n", "m"))
        bucket = rows.column("bucket")[0].as_py()
        low = start_key & ((1 << shift) - 1) if start_key >> shift == bucket else -1
        words = ((u & 3) == 1) & (u != low)
        around = [(int(words.sum()), int(n[words].sum()), int(m[words].sum()))]
        out, at = [], 0
        for block, keys in zip(rows.column("block").to_pylist(), sent):
            i = inverse[at:at + len(keys)]
            at += len(keys)
            out.append((block, bucket, _pack(n[i]), _pack(m[i]), *(around.pop() if around else (0, 0, 0))))
        return _table(out, ANSWERED)

    parts = max(1 << (BITS - shift), int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # a partition is a bucket or few
    return stored(asked.repartition(parts, "bucket").groupBy("bucket").applyInArrow(run, ANSWERED), "lm-answers")


def score(blocks: DataFrame, targets: DataFrame, answered: DataFrame) -> DataFrame:
    """doc_id, target, n_tokens, loss_target, loss_background, score per stored row of ``blocks``."""
    total = answered.agg(F.sum("words"), F.sum("tokens"), F.sum("target_tokens")).first()
    words, tokens, target_tokens = (int(v or 0) for v in total)
    # the marks of a block's targets travel with its answers
    said = answered.select("block", "bucket", "n", "m", F.lit(None).cast("int").alias("row")).unionByName(
        targets.select("block", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("n"), F.lit(None).cast("binary").alias("m"), "row"))

    def run(rows: pa.Table, own: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _table([], SCORED)
        said = [r for r in own.to_pylist() if r["row"] is None]
        said.sort(key=lambda r: r["bucket"])
        ids, target, grams = _read(rows, [r["row"] for r in own.select(["row"]).to_pylist() if r["row"] is not None])
        at, losses = grams.numbers(), []
        for column, events in (("n", tokens), ("m", target_tokens)):
            counts = np.concatenate([np.zeros(0, np.int64), *(_unpack(r[column]) for r in said)])
            here = grams.scored
            if not len(here):
                losses.append(np.zeros(0))
                continue
            p = (counts[at[0][here]] + 1.0) / (events + words)
            for order in (1, 2):
                p = (counts[at[order][here]] + K * p) / (counts[at[order - 1][here - 1]] + K)
            losses.append(-np.log2(p))
        n = np.bincount(grams.doc, minlength=len(ids))
        bg, tg = (np.bincount(grams.doc, v, len(ids)) for v in losses)
        return _table([(i, bool(t), int(k), g / k if k else None, b / k if k else None, (b - g) / k if k else 0.0)
                       for i, t, k, b, g in zip(ids, target, n.tolist(), bg.tolist(), tg.tolist())], SCORED)

    return (blocks.select("block", "row", "doc_id", "text").groupBy("block")
            .cogroup(said.groupBy("block")).applyInArrow(run, SCORED))


def cross_entropy_difference(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Score every row of ``docs(doc_id, text)`` against the documents listed in ``targets(doc_id)``."""
    size = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = store_blocks(docs, size)
    bucket_bits = (size // PER_BUCKET).bit_length()
    marked = target_rows(blocks, targets)
    return score(blocks, marked, answers(questions(blocks, marked, bucket_bits), BITS - bucket_bits))


def op10_lm_score(spark, sf_dir: str) -> DataFrame:
    """Target: documents labelled as good, outside the held-out fold (see ``quality.held_out``)."""
    labels = table(spark, sf_dir, "labels")
    targets = labels.where((F.col("quality") == 1) & ~held_out()).select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), targets)

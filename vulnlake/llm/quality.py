"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed once for every whole text and stored. The trees are fitted on a bounded sample of the
labelled rows (``FIT_ROWS``; a uniform hash of id and statistics chooses them, and all of them are used while there are
no more than that; rows that repeat both count once), with bin edges from the same sample. The fitted trees are flattened into arrays, broadcast
(a few hundred kilobytes whatever the corpus size), and traversed for a whole batch of documents at once.

Defined cases: null text is the empty text and gets a score like any other; several labels of one id count as
one, the larger; a null id is unlabelled and not held out; without usable labels of both values every score
is the base rate (0.5 without labels); repeated rows keep one result row each; texts of any length are measured whole;
an empty table gives an empty result; other columns are ignored (by ``keep_good``: kept), whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_batches, stored, table, text_or_empty

FIT_ROWS = 40_000  # bound of the labelled sample that the trees are fitted on
FEATURES = ("log_chars", "log_words", "word_len", "word_len_sd", "upper", "digit", "space", "symbol", "bang", "pipe", "stop",
            "comma", "non_ascii", "log_lines", "line_len", "dup_lines", "dup_line_chars", "distinct_words", "top_word",
            "repeat_next", "longest_repeat", "upper_words", "symbol_words", "log_symbol_words", "log_upper_words",
            "log_repeat", "long_words", "one_char_words", "worst_line_repeat", "worst_line_symbol", "dup_bigrams")

_BYTE_CLASS = np.zeros((9, 256), np.float64)
for _row, _chars in enumerate((range(65, 91), range(48, 58), (9, 10, 11, 12, 13, 32), b"#$%&*@^~<>=+_\\{}[]|/", b"!", b"|", b".", b",", range(128, 256))):
    _BYTE_CLASS[_row, list(_chars)] = 1.0
_SYMBOL_WORD = re.compile(r"[#$%&*@^~<>=+_\\{}\[\]|/!]{2}|^\|$")


def statistics(text: str) -> list[float]:
    """The numbers of ``FEATURES`` for one text, in that order."""
    data = text.encode("utf-8", "replace")
    n = max(1, len(data))
    shares = (_BYTE_CLASS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)) / n
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    w, m = max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts: dict[str, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    top = max(counts.values(), default=0)
    again = run = longest = 0
    for a, b in zip(words, words[1:]):
        if a == b:
            again += 1
            run += 1
            longest = max(longest, run)
        else:
            run = 0
    distinct_lines = set(lines)
    upper = sum(1 for x in words if len(x) > 2 and x.isupper())
    symbols = sum(1 for x in words if _SYMBOL_WORD.search(x))
    worst_repeat = worst_symbol = 0.0
    for line in lines:
        parts = line.split()
        if len(parts) >= 8:
            worst_repeat = max(worst_repeat, 1 - len(set(parts)) / len(parts))
            worst_symbol = max(worst_symbol, sum(1 for x in parts if _SYMBOL_WORD.search(x)) / len(parts))
    return [np.log1p(len(text)), np.log1p(len(words)), lengths.mean(), lengths.std(), *shares[:8], shares[8],
            np.log1p(len(lines)), np.log1p(len(text) / m), 1 - len(distinct_lines) / m if lines else 0.0,
            1 - sum(map(len, distinct_lines)) / max(1, sum(map(len, lines))), len(counts) / w, top / w, again / w,
            float(longest), upper / w, symbols / w, np.log1p(symbols), np.log1p(upper), np.log1p(again),
            float((lengths > 20).mean()), float((lengths == 1).mean()), worst_repeat, worst_symbol,
            1 - len(set(zip(words, words[1:]))) / max(1, len(words) - 1)]


def document_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, x)`` with ``x`` the list of statistics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([statistics(t.as_py()) for t in b.column(1)], np.float32).reshape(-1, len(FEATURES))
            offsets = pa.array(np.arange(len(rows) + 1) * len(FEATURES), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))], ["doc_id", "x"])

    return map_batches(docs.select("doc_id", text_or_empty().alias("text")), run, "doc_id bigint, x array<float>")


# ---- the trees --------------------------------------------------------------------------------------------------

@dataclass
class Trees:
    """Complete binary trees of one depth, flattened: node ``k`` of a tree has children ``2k+1`` and ``2k+2``.
    A node that was not split sends every row left."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # rows with x <= threshold go left
    value: np.ndarray  # (trees, leaves)
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.value.shape[1]))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - feature.shape[0]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 5, rate: float = 0.15, bins: int = 64,
        least: float = 5.0, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss; splits are sought over per-node histograms of gradient sums."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    rate_up = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(rate_up / (1 - rate_up)))
    if len(y) < 2 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    raw = np.full(len(y), base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-raw))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            n, first = 2 ** level, 2 ** level - 1
            best = np.zeros(n)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                key = (node - first) * bins + code[:, j]
                gl = np.bincount(key, g, n * bins).reshape(n, bins).cumsum(1)
                hl = np.bincount(key, h, n * bins).reshape(n, bins).cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gr, hr = gt - gl, ht - hl
                gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - gt ** 2 / (ht + ridge)
                gain[(hl < least / 4) | (hr < least / 4)] = 0
                cut = gain[:, :len(e)].argmax(1)
                top = gain[np.arange(n), cut]
                for k in np.flatnonzero(top > best + 1e-9):
                    best[k], feature[first + k], threshold[first + k] = top[k], j, e[cut[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        raw += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), base)


# ---- on Spark -----------------------------------------------------------------------------------------------------

def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on_labels(stats: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, **options) -> Trees:
    """Fit on ``labels(doc_id, quality)`` outside the held-out fold, at most about ``rows`` of them."""
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("quality").alias("y")))
    usable = stats.join(known, "doc_id").select("doc_id", "y", "x")
    n, ids = stats.select("doc_id").join(known.select("doc_id"), "doc_id").agg(F.count("*"), F.count_distinct("doc_id")).first()
    if n > ids:  # some ids repeat: equal rows count once
        usable = stored(usable.dropDuplicates(["doc_id", "x"]), "labelled-statistics")
        n = usable.count()
    if n > rows:
        usable = usable.where(F.pmod(F.xxhash64("doc_id", "x"), F.lit(1 << 20)) < F.lit(int((1 << 20) * rows / n)))
    got = usable.toArrow()  # about ``rows`` of them at most
    got = got.append_column("k", pa.array([bytes(np.asarray(v, "<f4")) for v in got.column("x").to_pylist()], pa.binary()))
    got = got.sort_by([("doc_id", "ascending"), ("y", "ascending"), ("k", "ascending")])
    x = np.array(got.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES)) if got.num_rows else np.zeros((0, len(FEATURES)), np.float32)
    return fit(x.astype(np.float64), np.array(got.column("y")).astype(np.float64), **options)


def score(stats: DataFrame, trees: Trees) -> DataFrame:
    """``(doc_id, x)`` -> ``(doc_id, score)``."""
    model = stats.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column(1).flatten()).reshape(b.num_rows, len(FEATURES)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.value.score(x))], ["doc_id", "score"])

    return map_batches(stats.select("doc_id", "x"), run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, **options) -> DataFrame:
    """Score every row of ``docs(doc_id, text)``: doc_id, held_out, score, predicted."""
    stats = stored(document_statistics(docs), "document-statistics")
    scored = score(stats, fit_on_labels(stats, labels, rows, **options))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier, fitted on ``docs`` and ``labels``, does not reject."""
    @F.pandas_udf("array<float>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(statistics(t), np.float32) for t in texts])

    name = free_name(docs, "statistics")
    measured = stored(docs.withColumn(name, measure(text_or_empty())), "measured-documents", "zstd")
    model = docs.sparkSession.sparkContext.broadcast(
        fit_on_labels(measured.select("doc_id", F.col(name).alias("x")), labels, rows, **options))

    @F.pandas_udf("boolean")
    def good(x: pd.Series) -> pd.Series:
        return pd.Series(model.value.score(np.stack(x.to_list()).astype(np.float64)) >= 0.5) if len(x) else pd.Series([], dtype=bool)

    return measured.where(good(name)).select(*docs.columns)


def op1_quality(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

"""Ranked lexical search by NRA (no random access) over impact-sorted posting lists.

1. One pass over the texts: every document's number of terms and, for the terms of the queries only, how often each
   occurs. This is stored; counts of documents, terms and documents per term are sums over it.
2. Documents come in blocks of bounded size, wherever they lie: no key gathers them. A block's postings are sorted by
   term and falling impact, and each query reads its lists from the top, level by level. A document's score lies
   between what was read of it (lower bound) and that plus, for each list it has not been met in, the largest impact not yet
   read there (upper bound). Documents whose upper bound is below the k-th best lower bound leave the race; reading
   goes on until all that are left have equal bounds, so that membership, ties and scores are final. The k-th best score
   of a task's earlier blocks is the bar for its next one.
3. Each task hands on at most k documents a query; windows keep the k best, first by groups of tasks, then by query.

Queries are taken in groups of at most ``QUERY_TERMS`` distinct terms, the bound of what is broadcast; a group is one round of
the above. Everything is 64-bit integer arithmetic but a term's weight, which is taken in doubles.

Defined cases: null texts have no terms; documents without terms count nowhere and are never returned; each row of the
documents and of the queries is one of its own, so repeated rows are ranked beside each other; equal scores go by
ascending id, null ids last, then in any order among rows with equal ids; a query without terms, or whose terms occur nowhere, has no
rows; texts of any length are read whole; empty tables give an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, stored, table, text_or_empty

TOP = 50
QUERY_TERMS = 100_000  # distinct terms of a group of queries
BLOCK_POSTINGS = 1_000_000  # of the documents ranked together
BLOCK_DOCS = 16_384
STEP = 0.7  # each level reads down to this share of the one before
MERGE_GROUPS = 64
NULL_ID = np.iinfo(np.int64).max

# Term characters: letters and digits of ASCII, and every byte of a longer character; A-Z are lower-cased.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


@dataclass(frozen=True)
class Queries:
    """A group of queries: the number of each distinct term, and each query's terms."""

    numbers: dict[bytes, int]
    terms: list[tuple[int, np.ndarray]]  # (row of the query, numbers of its terms)


def query_groups(queries: DataFrame, text: str = "text", most: int = QUERY_TERMS) -> Iterator[Queries]:
    """``queries(query, text)`` in groups of at most ``most`` distinct terms (a query with more is a group of its own)."""
    numbers: dict[bytes, int] = {}
    terms: list[tuple[int, np.ndarray]] = []
    for row in queries.select("query", F.col(text).cast("binary").alias("text")).toLocalIterator():  # one partition at a time
        own = dict.fromkeys(terms_of(bytes(row["text"] or b"")))
        if not own:
            continue
        if terms and len(numbers.keys() | own.keys()) > most:
            yield Queries(numbers, terms)
            numbers, terms = {}, []
        for t in own:
            numbers.setdefault(t, len(numbers))
        terms.append((row["query"], np.array([numbers[t] for t in own], np.int64)))
    if terms:
        yield Queries(numbers, terms)


def postings(docs: DataFrame, queries, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored, one row per document with terms: ``id, n`` and, of the queries' terms, their numbers and frequencies."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = queries.value.numbers.get
        for b in batches:
            ids, sizes, terms, counts = [], [], [], []
            for i, data in zip(b.column(0), b.column(1)):
                words = terms_of(data.as_py())
                if words:
                    own = Counter(map(get, words))
                    own.pop(None, None)
                    ids.append(i.as_py())
                    sizes.append(len(words))
                    terms.append(list(own))
                    counts.append(list(own.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["id", "n", "terms", "counts"])

    source = docs.select(F.col(id).cast("bigint").alias("id"), text_or_empty(text).cast("binary").alias("text"))
    return stored(map_batches(source, read, "id bigint, n bigint, terms array<int>, counts array<bigint>"), "postings")


@dataclass(frozen=True)
class Statistics:
    documents: int
    words: int
    weight: np.ndarray  # by term number; 0 for terms that occur nowhere


def statistics(found: DataFrame, n_terms: int) -> Statistics:
    total = found.agg(F.count("*").alias("n"), F.sum("n").alias("words")).first()
    weight = np.zeros(n_terms, np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():  # one row a query term
        weight[r["t"]] = math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * r["df"] + 1)))
    return Statistics(total["n"], total["words"] or 0, weight)


class Block:
    """Impact-sorted posting lists of some documents."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, stats: Statistics):
        m = 50 + (50 * n * stats.documents) // stats.words
        impact = stats.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        order = np.lexsort((-impact, term))
        order = order[impact[order] > 0]
        self.ids, self.doc, self.impact = ids, doc[order], impact[order]
        self.names, self.begin, sizes = np.unique(term[order], return_index=True, return_counts=True)
        self.end = self.begin + sizes

    def lists(self, terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        at = np.searchsorted(self.names, terms)
        at = at[(at < len(self.names)) & (self.names[np.minimum(at, len(self.names) - 1)] == terms)] if len(self.names) else at[:0]
        return [(self.doc[self.begin[k]:self.end[k]], self.impact[self.begin[k]:self.end[k]]) for k in at.tolist()]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best: highest score first, then smallest id."""
    return np.lexsort((ids, -scores))[:k]


def nra(block: Block, terms: np.ndarray, k: int, bar: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the block (their numbers) that may be among the k best, with final scores: all with a positive score
    of at least ``bar`` and of at least the k-th best score of the block."""
    lists = block.lists(terms)
    size = len(block.ids)
    lower, alive, read = np.zeros(size, np.int64), np.ones(size, bool), [0] * len(lists)
    met = np.zeros((len(lists), size), bool)
    front = np.array([impact[0] for _, impact in lists], np.int64)  # the largest impact of each list not yet read
    candidates = np.arange(size)
    level = int(front.max(initial=0))
    while level > 0 and len(candidates):
        for t, (doc, impact) in enumerate(lists):
            if not front[t] or front[t] < level:
                continue
            end = int(np.searchsorted(-impact, -level, "right"))
            new = doc[read[t]:end]
            lower[new] += impact[read[t]:end]
            met[t, new] = True
            read[t], front[t] = end, impact[end] if end < len(impact) else 0
        now = lower[candidates]
        if len(now) >= k:
            bar = max(bar, int(np.partition(now, len(now) - k)[len(now) - k]))
        open_lists = np.flatnonzero(front)
        if not len(open_lists):
            break
        upper = now + front[open_lists].sum() - front[open_lists] @ met[np.ix_(open_lists, candidates)]
        keep = upper >= max(bar, 1)
        candidates, settled = candidates[keep], (upper == now)[keep].all()
        if settled:  # every interval has closed
            break
        alive[:] = False
        alive[candidates] = True
        if len(candidates) < size // 8:  # few are left: of the lists, only their postings are read on
            for t in open_lists.tolist():
                doc, impact = lists[t][0][read[t]:], lists[t][1][read[t]:]
                mine = alive[doc]
                lists[t], read[t] = (doc[mine], impact[mine]), 0
                front[t] = lists[t][1][0] if len(lists[t][1]) else 0
        level = min(int(level * STEP), int(front.max(initial=0)))
    scores = lower[candidates]
    keep = (scores > 0) & (scores >= bar)
    return candidates[keep], scores[keep]


def _blocks(batches: Iterator[pa.RecordBatch], stats: Statistics) -> Iterator[Block]:
    held: list[pa.RecordBatch] = []
    docs = size = 0

    def build() -> Block:
        whole = pa.Table.from_batches(held).combine_chunks()
        ids, n = whole["id"].fill_null(NULL_ID).to_numpy(), whole["n"].to_numpy()
        terms, counts = whole["terms"].combine_chunks(), whole["counts"].combine_chunks()
        lengths = np.diff(terms.offsets.to_numpy())
        return Block(ids, n, np.repeat(np.arange(len(ids)), lengths), terms.flatten().to_numpy(), counts.flatten().to_numpy(), stats)

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            b = batch.slice(at, 1024)
            held.append(b)
            docs, size = docs + b.num_rows, size + len(b.column(2).flatten())
            if docs >= BLOCK_DOCS or size >= BLOCK_POSTINGS:
                yield build()
                held, docs, size = [], 0, 0
    if docs:
        yield build()


def rank(found: DataFrame, queries, stats, k: int) -> DataFrame:
    """``query, id, score, part``: at most k documents of each query from each task, the best of all among them."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, s = queries.value, stats.value
        kept = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(q.terms)
        for block in _blocks(batches, s):
            for j, (_, terms) in enumerate(q.terms):
                ids, scores = kept[j]
                bar = int(scores[-1]) if len(scores) == k else 0
                new, new_scores = nra(block, terms, k, bar)
                ids, scores = np.concatenate([ids, block.ids[new]]), np.concatenate([scores, new_scores])
                top = best(scores, ids, k)
                kept[j] = ids[top], scores[top]
        part = TaskContext.get().partitionId()
        for at in range(0, len(kept), 256):
            mine = [(j, *kept[j]) for j in range(at, min(at + 256, len(kept))) if len(kept[j][0])]
            if mine:
                ids = np.concatenate([i for _, i, _ in mine])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q.terms[j][0] for j, _, _ in mine], [len(i) for _, i, _ in mine])), pa.array(ids, mask=ids == NULL_ID),
                     pa.array(np.concatenate([x for _, _, x in mine])), pa.array(np.full(len(ids), part % MERGE_GROUPS, np.int32))],
                    ["query", "id", "score", "part"])

    return map_batches(found, search, "query bigint, id bigint, score bigint, part int")


def _top(df: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, doc_id: str = "doc_id", query_id: str = "item_id", text: str = "text",
           most_terms: int = QUERY_TERMS) -> DataFrame:
    """The k highest-scoring documents of each row of ``queries``: query id, rank, doc id, score."""
    spark = docs.sparkSession
    numbered = stored(queries.select(F.col(query_id).alias("query_id"), F.col(text).alias("text"),
                                     F.monotonically_increasing_id().alias("query")), "queries")
    out = None
    for group in query_groups(numbered, most=most_terms):
        shared = spark.sparkContext.broadcast(group)
        found = postings(docs, shared, doc_id, text)
        stats = spark.sparkContext.broadcast(statistics(found, len(group.numbers)))
        ranked = _top(_top(rank(found, shared, stats, k), ["query", "part"], k).drop("rank"), ["query"], k)
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], "query bigint, id bigint, score bigint, rank int")
    return out.join(numbered.select("query", "query_id"), "query").select(
        F.col("query_id").alias(query_id), "rank", F.col("id").alias(doc_id), "score")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """For every benchmark item its ``TOP`` highest-scoring documents, of all."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

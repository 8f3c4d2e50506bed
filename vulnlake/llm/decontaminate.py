"""Benchmark decontamination over a distributed positional inverted index (DataFrame functions only).

1. The words of every document are stored once, under a row number.
2. The index: one posting ``(term, row, position)`` for every occurrence of an indexed term. Postings are first
   counted for the terms of the test windows; each window then takes its rarest terms (``ANCHORS`` of them, from
   different places) and only anchor terms are stored as postings.
3. A window's postings, shifted back by the term's offset in the window, all name the same start where the
   window occurs: the lists are intersected by an equi-join on (window, row, start), rarest term first.
4. What is left is compared word by word with the words around the posting, so the matches are exact.

The terms that filter postings are the distinct terms of the test items: they are broadcast while they stay
under ``BROADCAST_TERMS`` (checked), and joined by a shuffle beyond that.

Defined cases: null text has no words and is never contaminated; an item without words gives no window; an item
without an id counts as ``null``; repeated rows keep one result row each, repeated items count once per id; with
an empty benchmark nothing is contaminated; texts of any length are compared whole; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table

WINDOW = 13
ANCHORS = 2
BROADCAST_TERMS = 1_000_000  # about 32 MB of terms
# What separates words, after A-Z are lower-cased.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), NOT_WORD), lambda w: w != "")


def stored_words(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` -> stored ``(row, doc_id, text_hash, n_words, words)``."""
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of("text").alias("words"))
    return stored(words.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_hash",
                               F.size("words").cast("bigint").alias("n_words"), "words"), "words", "zstd")


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: ``(win, item, at, term)``, one row per word; ``item`` lists are kept apart."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), words_of("text").alias("words"))
    items = items.where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("win")).distinct()


def _only_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings whose term is listed; the list is broadcast only while its counted size allows it."""
    small = terms.count() <= BROADCAST_TERMS
    return postings.join(F.broadcast(terms) if small else terms, "term", "left_semi")


def index_postings(words: DataFrame, terms: DataFrame, reach: int = 0) -> DataFrame:
    """The positional index of ``terms``: stored ``(term, row, pos, first, around)``, positions from 1. ``around``
    holds the words from ``first`` = ``pos - reach`` (1 at least) to ``pos + reach``, separated by spaces."""
    small = terms.count() <= BROADCAST_TERMS
    if small:  # the text's words are at hand where its postings are made
        found = words.select("row", "words", F.posexplode("words").alias("p", "term")).join(F.broadcast(terms), "term", "left_semi")
    else:
        found = _only_terms(words.select("row", F.posexplode("words").alias("p", "term")), terms).join(words.select("row", "words"), "row")
    found = found.withColumn("pos", F.col("p") + 1)
    if reach:
        found = found.withColumn("first", F.greatest(F.col("pos") - reach, F.lit(1)))
        return stored(found.select("term", "row", "pos", "first", F.array_join(
            F.slice("words", F.col("first"), F.col("pos") + reach + 1 - F.col("first")), " ").alias("around")), "postings")
    return stored(found.select("term", "row", "pos"), "postings")


def term_counts(words: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences in the corpus of each of ``terms`` (those without any are missing)."""
    return _only_terms(words.select(F.explode("words").alias("term")), terms).groupBy("term").agg(F.count("*").alias("tf"))


def phrase_matches(words: DataFrame, windows: DataFrame, longest: int = WINDOW) -> DataFrame:
    """Every occurrence of a distinct ``win`` array of ``windows``: ``(row, start, win)``, starts from 1. No
    window has more than ``longest`` words."""
    wins = windows.select("win").distinct().select(F.xxhash64("win").alias("w"), "win")
    wins = stored(wins, "windows")
    places = wins.select("w", "win", F.posexplode("win").alias("at", "term"))
    counts = stored(term_counts(words, places.select("term").distinct()), "term-counts")
    # a window with a term that the corpus lacks cannot occur
    known = places.join(counts, "term", "left").withColumn("tf", F.coalesce("tf", F.lit(0)))
    rank = Window.partitionBy("w", "win").orderBy("tf", "at")
    anchors = stored(known.withColumn("rank", F.row_number().over(rank)).withColumn("least", F.min("tf").over(Window.partitionBy("w", "win")))
                     .where((F.col("least") > 0) & (F.col("rank") <= ANCHORS)).select("w", "win", "at", "term", "rank"), "anchors")
    index = index_postings(words, anchors.select("term").distinct(), longest)

    def shifted(rank_no: int, *more: str) -> DataFrame:
        chosen = anchors.where(F.col("rank") == rank_no).select("w", "win", "at", "term")
        return index.join(chosen, "term").select("w", "win", "row", (F.col("pos") - F.col("at")).alias("start"), *more).where("start >= 1")

    hits = shifted(1, "first", "around")
    for k in range(2, ANCHORS + 1):
        one_word = F.size("win") < k  # windows too short to have this anchor pass
        listed = shifted(k).select("w", "row", "start", "win")
        hits = hits.where(~one_word).join(listed, ["w", "row", "start", "win"], "left_semi").unionByName(hits.where(one_word))
    # at least 1: the optimizer may look at starts before the text, which the filter above takes out
    offset = F.greatest(F.col("start") - F.col("first") + 1, F.lit(1)).cast("int")
    same = F.slice(F.split("around", " "), offset, F.size("win")) == F.col("win")
    return hits.where(same).select("row", "start", "win")


def proximity_matches(words: DataFrame, windows: DataFrame, slop: int) -> DataFrame:
    """Places where all distinct words of a ``win`` occur within ``size(win) + slop`` words: ``(row, start, win)``
    with ``start`` the first position of a shortest such stretch that begins at a word of ``win``."""
    wins = stored(windows.select("win").distinct().select(F.xxhash64("win").alias("w"), F.array_distinct("win").alias("terms"), "win"), "windows")
    places = wins.select("w", "win", F.size("terms").alias("need"), F.explode("terms").alias("term"))
    index = index_postings(words, places.select("term").distinct())
    hits = index.join(places, "term")
    span = hits.select("w", "win", "need", "row", "pos", "term", (F.size("win") + slop).alias("span"))
    # every posting opens a stretch; the postings of the same window and row that fall into it are collected by
    # blocks of the stretch's length, so a join never meets more than two neighbouring blocks
    block = span.withColumn("block", F.expr("pos div span"))
    opens = block.select("w", "win", "need", "row", F.col("pos").alias("start"), "span", F.explode(F.array("block", F.col("block") + 1)).alias("block"))
    joined = opens.join(block.select("w", "win", "row", "block", "pos", "term"), ["w", "win", "row", "block"]).where(
        (F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + F.col("span")))
    return (joined.groupBy("w", "win", "row", "start", "need").agg(F.count_distinct("term").alias("n"))
            .where("n = need").select("row", "start", "win"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: row, doc_id, text_hash, n_words, n_hit, items (sorted item ids), contaminated."""
    words = stored_words(docs)
    windows = stored(test_windows(benchmark, window), "test-windows")
    found = stored(phrase_matches(words, windows, window), "phrase-matches")
    # hit words: the union of the intervals [start, start + length), per row; a row has at most its words in starts
    runs = found.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", F.size("win").alias("n")))).alias("runs"))
    covered = F.aggregate(
        "runs", F.struct(F.lit(1).alias("upto"), F.lit(0).alias("n")),
        lambda acc, r: F.struct(
            F.greatest(acc["upto"], r["start"] + r["n"]).alias("upto"),
            (acc["n"] + F.greatest(r["start"] + r["n"] - F.greatest(acc["upto"], r["start"]), F.lit(0))).alias("n")))
    hit = runs.select("row", covered["n"].cast("bigint").alias("n_hit"))
    items = (found.select("row", "win").distinct().join(windows, "win").groupBy("row")
             .agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    out = words.select("row", "doc_id", "text_hash", "n_words").join(hit.join(items, "row"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return out.select("row", "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")

"""Helpers shared by the operators: table access, durable intermediate tables, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a new folder under the shared scratch root and read it back: cuts the lineage, and a
    lost executor costs nothing that was stored. Whole texts are stored with ``compression`` zstd."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names are compared without regard to case)."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


BATCH_ROWS = 512  # of whole texts, or of whole shingle sets


def small_batches(spark: SparkSession) -> None:
    """From now on rows go to Python in Arrow batches of at most ``BATCH_ROWS``, less if the session says so. Both sides hold
    whole batches outside the heap; Spark's 10,000 rows of texts or shingle sets are tens of megabytes in each task,
    and the JVM keeps what it has once taken."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows``: what a task makes of one part at a time stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items that reach ``most`` together, or end."""
    start = total = 0
    for k, size in enumerate(sizes):
        total += size
        if total >= most:
            yield start, k + 1
            start, total = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def distinct_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of a binary array between x20 and x09-x0D, with ``lower`` A-Z lower-cased: the distinct ones, the number of the
    distinct word at every place of the texts in turn, and where each text's places begin (and the last one's end).
    One of the distinct words may be empty; places hold no empty words."""
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return texts, np.zeros(0, np.int64), np.zeros(1, np.int64)
    # ``ascii_lower`` gives wrong rows where the values do not begin at the buffer's start, as in slices
    begin = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = (texts.buffers()[2] or pa.py_buffer(b"")).slice(begin[0], begin[-1] - begin[0])
    values = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(begin - begin[0]), data)
    found = pc.ascii_split_whitespace(pc.ascii_lower(values) if lower else values)
    coded = found.values.dictionary_encode()
    places, begin = coded.indices.to_numpy(), found.offsets.to_numpy()
    empty = np.flatnonzero(pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) == 0)
    if len(empty):  # white space at an end of a text leaves an empty word there
        kept = places != empty[0]
        begin = np.concatenate([[0], np.cumsum(kept)])[begin]
        places = places[kept]
    return coded.dictionary.view(pa.large_binary()), places, begin


def as_words(distinct: pa.Array) -> list[bytes]:
    """A large binary array of words without x20 as a list; ``to_pylist`` takes many times as long."""
    if not len(distinct):
        return []
    one = pa.LargeListArray.from_arrays(pa.array([0, len(distinct)], pa.int64()), distinct)
    return pc.binary_join(one, pa.scalar(b" ", pa.large_binary()))[0].as_buffer().to_pybytes().split(b" ")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(id, component)``, component = the smallest reachable id.

    Alternating large-star and small-star steps; each step is two map-side combined aggregations and a join
    that adaptive execution may split, so a node with many neighbours is no single task's work. Each round is
    stored. Nodes without edges are not in the result.
    """
    def with_min(directed: DataFrame) -> DataFrame:
        low = directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return directed.join(low, "u")

    cur = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select("u", F.col("m").alias("v")).unionByName(
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        cur = stored(small, label)
        # done when all that is left are stars: every node but the roots has one edge, to a root
        ends = cur.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(cur.select(F.col("v").alias("x"), F.lit(0).alias("up")))
        nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.min("up").alias("low"))
        if not nodes.agg(F.sum(F.when((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("low") == 0)), 1))).first()[0]:
            break
    leaves = cur.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return leaves.unionByName(cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())

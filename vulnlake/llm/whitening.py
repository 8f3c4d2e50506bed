"""Embedding whitening by a bidiagonal qd solver.

1. Entries become whole numbers; their count and sums per dimension are exact, so centring is ``(n x - S) / n`` with
   the numerator exact.
2. Blockwise QR: every task reduces its centred rows to one triangular R, and the R of many tasks are reduced
   in groups of bounded size until one is left. No cross products are formed, so small variances keep their digits.
3. ``qd`` takes that R (dimension by dimension) to bidiagonal form and finds the singular values by dqds and the leading
   directions by twisted factorisations.
4. A last pass projects every row. The covariance of what came out is then measured, centred before multiplying.

What the driver sees is sized by the dimension of the vectors: sums, a bounded number of R, the directions.

Defined cases. Vectors that are null or hold a null, NaN or infinite entry (or one whose whole number is beyond 53 bits)
are dropped; so are vectors of another length than the commonest (the longer of two equally common). Null and repeated ids
and repeated vectors stay, one group of rows each. An empty table gives an empty result. A component whose variance is zero
to rounding cannot be whitened: its rows are there, ``whitened`` is null and it has no part in ``identity_error``.
``deviation`` is null where the number is beyond 64 bits (``deviation_wide`` has it up to 38 digits). Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored, table
from .qd import EPS, right_singular

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
BLOCK = 4096  # rows of a QR block at least; four times the dimension if that is more
GATHERED = 64 << 20  # bytes of R that meet in one task, or on the driver
SMALL = 1 << 62


def whole_numbers(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, x``: the usable vectors as arrays of whole numbers."""
    c = F.col(vector).cast("array<double>")
    usable = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float(1 << 43)))
    return vectors.where(F.col(vector).isNotNull() & usable).select(
        F.col(id).alias("id"), F.transform(c, lambda v: F.floor(v * F.lit(float(SCALE))) + F.lit(OFFSET)).alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """Batches with their list column as a matrix of ``width`` columns."""
    for b in batches:
        if b.num_rows:
            yield b.column(column).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width), b


def sums(x: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors of the commonest length and their exact sums per dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for b in batches:
            lists, sizes = b.column(0), np.diff(b.column(0).offsets.to_numpy())
            flat, starts = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[:-1]
            for width in np.unique(sizes).tolist():
                mine = starts[sizes == width]
                m = flat[mine[:, None] + np.arange(width)[None, :]]
                hi, lo = (m >> 31).sum(0), (m & 0x7FFFFFFF).sum(0)  # halves: their sums fit 64 bits
                n, total = found.get(width, (0, [0] * width))
                found[width] = n + len(mine), [t + (h << 31) + low for t, h, low in zip(total, hi.tolist(), lo.tolist())]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int32()), pa.array([n for n, _ in found.values()], pa.int64()),
                 pa.array([[str(v) for v in s] for _, s in found.values()], pa.list_(pa.string()))], ["width", "n", "s"])

    per_task = stored(map_batches(x.select("x"), add, "width int, n bigint, s array<string>"), "sums")
    best = per_task.groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if best is None or best["width"] == 0:
        return 0, []
    rows = (per_task.where(F.col("width") == best["width"]).select(F.posexplode("s").alias("d", "s"))
            .groupBy("d").agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")).collect())  # one row a dimension
    return best["n"], [int(r["s"]) for r in sorted(rows, key=lambda r: r["d"])]


def _deviations(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """``n x - S``, exact: 64-bit where it fits, else Python integers."""
    if n * (int(np.abs(x).max(initial=0)) + 1) < SMALL and all(abs(v) < SMALL for v in s):
        return n * x - s.astype(np.int64)
    return n * x.astype(object) - s


def _stack(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")


def triangular(x: DataFrame, n: int, s: list[int]) -> np.ndarray:
    """R of the QR decomposition of the centred vectors."""
    width, mean_sums = len(s), np.array(s, object)
    block = max(BLOCK, 4 * width)

    def emit(part: int, r: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.tobytes()], pa.binary()),
                                              pa.array([len(r)], pa.int32())], ["part", "r", "height"])

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, rows, waiting = None, [], 0
        for m, _ in _blocks(batches, 0, width):
            for k in range(0, len(m), block):
                rows.append(_deviations(m[k:k + block], n, mean_sums).astype(float) / n)
                waiting += len(rows[-1])
                if waiting >= block:
                    r, rows, waiting = _stack(r, np.vstack(rows)), [], 0
        if rows:
            r = _stack(r, np.vstack(rows))
        yield from emit(TaskContext.get().partitionId(), r)

    def read(rows) -> list[np.ndarray]:
        return [np.frombuffer(data, float).reshape(height, width) for data, height in rows]

    def reduce_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for b in batches:
            for one in read(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                r = _stack(r, one)
        yield from emit(TaskContext.get().partitionId(), r)

    shape, fan = "part bigint, r binary, height int", max(2, min(64, GATHERED // (8 * width * width)))
    parts = stored(map_batches(x.select("x"), reduce_rows, shape), "triangles")
    while (left := parts.count()) > fan:
        groups = ceil(left / fan)
        dealt = parts.repartitionByRange(groups, "part")
        parts = stored(map_batches(dealt, reduce_group, shape), "triangles")
    r = None
    for one in read(parts.orderBy("part").select("r", "height").collect()):  # at most ``fan`` small matrices
        r = _stack(r, one)
    return np.vstack([r, np.zeros((width - len(r), width))])  # fewer vectors than dimensions: rows of zeros


def whiten(vectors: DataFrame, components: int = COMPONENTS, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: the id, component, n, deviation, deviation_wide, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    x = whole_numbers(vectors, id, vector)
    kind = x.schema["id"].dataType.simpleString()
    n, s = sums(x)
    names = f"`{id}` {kind}, component int, n bigint, deviation bigint, deviation_wide decimal(38,0), whitened double, explained double, identity_error double"
    if not n:
        return spark.createDataFrame([], names)
    width, mean_sums = len(s), np.array(s, object)
    x = x.where(F.size("x") == width)
    squares, directions = right_singular(triangular(x, n, s), min(components, width))
    k, floor = directions.shape[1], squares[0] * (8 * width * EPS) ** 2
    usable = [bool(v > floor) for v in squares[:k]]
    scaled = directions * np.array([np.sqrt(n / v) if ok else 0.0 for v, ok in zip(squares, usable)])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m, b in _blocks(batches, 1, width):
            dev = _deviations(m, n, mean_sums)
            if dev.dtype == object or width * int(np.abs(dev).max(initial=0)) ** 2 >= SMALL:
                squared = [sum(int(v) ** 2 for v in row) for row in dev]
            else:
                squared = (dev * dev).sum(1).tolist()
            w = (dev.astype(float) / n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([str(v) for v in squared], pa.string()),
                 pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), k).cast(pa.list_(pa.float64()))], ["id", "deviation", "w"])

    rows = stored(map_batches(x.select("id", "x"), project, f"id {kind}, deviation string, w array<double>"), "whitened")
    kept = [j for j in range(k) if usable[j]]
    error = None
    if kept:
        means = rows.agg(*[F.avg(F.col("w")[j]).alias(f"m{j}") for j in kept]).first()
        off = {j: F.col("w")[j] - F.lit(means[f"m{j}"]) for j in kept}
        pairs = [(i, j) for i in kept for j in kept if i <= j]
        cov = rows.agg(*[F.avg(off[i] * off[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    share = squares[:k] / squares.sum() if squares[0] > 0 else np.zeros(k)
    at = F.col("component") - 1
    wide = F.expr("try_cast(deviation AS decimal(38,0))")
    return (rows.select("id", "deviation", F.posexplode("w").alias("pos", "value"))
            .select(F.col("id"), (F.col("pos") + 1).alias("component"), "deviation", "value")
            .select(F.col("id").alias(id), "component", F.lit(n).cast("bigint").alias("n"),
                    F.expr("try_cast(deviation AS bigint)").alias("deviation"), wide.alias("deviation_wide"),
                    F.when(F.get(F.array(*[F.lit(u) for u in usable]), at), F.col("value")).alias("whitened"),
                    F.get(F.array(*[F.lit(float(v)) for v in share]), at).alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every usable embedding on the eight leading components."""
    return whiten(table(spark, sf_dir, "embeddings"))

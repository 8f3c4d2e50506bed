"""Upsert of re-published records into a partitioned parquet table: the latest row of each key wins, and only the
partitions that a change lands in are rewritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import table_schema


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``order`` columns (NULL is the smallest value), among equals the
    largest row. Partial maxima are taken map-side, so a hot key ships one row per task. The maximum of a struct has
    no hash buffer: both sides of the exchange sort, by a hash of the key first, which decides nearly every
    comparison where keys share their beginning."""
    rest = [c for c in df.columns if c not in (key, *order)]
    best = df.groupBy(F.xxhash64(key).alias("_key_hash"), key).agg(F.max(F.struct(*order, *rest)).alias("_best"))
    return best.select(*[F.col(key) if c == key else F.col("_best")[c].alias(c) for c in df.columns])


def _version(order: Sequence[str]) -> Column:
    return F.struct(*order)


def upsert_table(spark: SparkSession, path: str, changes: DataFrame, key: str, order: Sequence[str], partition_by: str,
                 compression: str = "zstd") -> dict[str, int]:
    """Merge ``changes`` into the table at ``path`` (one row per ``key``, partitioned by ``partition_by``): unknown keys are
    inserted; a known key's row is replaced when the change's ``order`` columns are larger than the stored row's, so a late
    old delivery, or the same changes again, alter nothing. Returns how many rows were inserted and updated and
    how many partitions were rewritten. The result equals ``latest_per_key`` over the old table and all changes.

    The stored table is read twice: key, order and partition columns are joined with the changes' keys (a side that adaptive
    execution broadcasts while it is small, and splits otherwise), then the partitions where something changes are read whole.
    Their new content is staged in the shared folder before the dynamic partition overwrite begins, so
    nothing is read from files that are being replaced; the other partitions' files are not touched.

    ``partition_by`` must be a function of the key, as a record's year is of its id: a change that would move a record to
    another partition is refused with ValueError, before anything is written. Changes without a key are refused as well. ``changes`` must
    have the table's columns; others are refused (``write_table(..., schema="merge")`` adds columns).
    """
    latest = _staged(latest_per_key(changes, key, order), "upsert-changes")
    if latest.where(F.col(key).isNull()).limit(1).count():
        raise ValueError(f"changes without {key}")
    schema = table_schema(spark, path)
    if schema is None:
        n = latest.agg(F.count(F.lit(1)), F.count_distinct(F.coalesce(F.col(partition_by).cast("string"), F.lit("")))).first()
        _write(latest, path, partition_by, compression)
        return {"inserted": n[0], "updated": 0, "partitions": n[1]}
    if set(schema.names) != set(changes.columns):
        raise ValueError(f"the table has the columns {sorted(schema.names)}, the changes {sorted(changes.columns)}")
    stored = spark.read.schema(schema).parquet(path)
    latest = latest.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    known = stored.select(key, F.col(partition_by).alias("_old_part"), _version(order).alias("_old")).join(
        latest.select(key, F.col(partition_by).alias("_new_part"), _version(order).alias("_new")), key)
    known = _staged(known.select(key, (F.col("_new") > F.col("_old")).alias("_wins"),
                                 (~F.col("_old_part").eqNullSafe(F.col("_new_part"))).alias("_moves")), "upsert-known")
    totals = known.agg(F.count(F.when(F.col("_wins"), 1)).alias("updated"), F.count(F.when(F.col("_moves"), 1)).alias("moves")).first()
    if totals["moves"]:
        raise ValueError(f"{totals['moves']} changes would move a record to another {partition_by}")
    winners = _staged(latest.join(known.where("not _wins"), key, "left_anti"), "upsert-winners")
    parts = [r[0] for r in winners.select(partition_by).distinct().collect()]  # one value per partition
    if not parts:
        return {"inserted": 0, "updated": 0, "partitions": 0}
    values = [p for p in parts if p is not None]
    touched = F.col(partition_by).isin(values) if values else F.lit(False)
    if None in parts:
        touched = touched | F.col(partition_by).isNull()
    kept = stored.where(touched).join(winners.select(key), key, "left_anti")
    merged = _staged(kept.select(*schema.names).unionByName(winners.select(*schema.names)), "upsert-merged")
    _write(merged, path, partition_by, compression)
    inserted = winners.join(known.select(key), key, "left_anti").count()
    return {"inserted": inserted, "updated": totals["updated"], "partitions": len(parts)}


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write(df: DataFrame, path: str, partition_by: str, compression: str) -> None:
    # rows of a partition go to few tasks, so each writes to few folders; a partition of any size is split
    (df.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).partitionBy(partition_by).parquet(path))

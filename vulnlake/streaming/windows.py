"""Stateful streaming: tumbling counts with a watermark, late rows and re-deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tumbling_counts(stream: DataFrame, time: str, width: str, delay: str, keys: Sequence[str] = (), id: str | None = None,
                    sums: Sequence[str] = ()) -> DataFrame:
    """``window_start, window_end``, the keys, ``n_rows`` and ``sum_<col>``, per tumbling window of ``width``.

    The watermark is the largest time seen in earlier batches less ``delay``: rows behind it are late and are left out, and
    state behind it is dropped, so state is bounded by the windows within ``delay``, not by the stream. With ``id``, a row
    delivered again within the watermark counts once. On a batch DataFrame the same plan counts all rows,
    each id once.
    """
    rows = stream.where(F.col(time).isNotNull())
    if stream.isStreaming:
        rows = rows.withWatermark(time, delay)
        if id:
            rows = rows.dropDuplicatesWithinWatermark([id])
    elif id:
        rows = rows.dropDuplicates([id])
    counted = rows.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n_rows"), *_sums(sums))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n_rows", *[f"sum_{c}" for c in sums])


def _sums(sums: Sequence[str]) -> list[Column]:
    return [F.sum(c).alias(f"sum_{c}") for c in sums]


def start_window_counts(counts: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep the results of a streaming ``tumbling_counts`` up to date under ``path``.

    Every batch writes the windows it changed into a folder of its own number and replaces that folder if it runs again after a
    failure, so a restart from the checkpoint neither loses nor repeats a count. Open windows are there as well. A
    window is in the folders of all batches that changed it, which are at most those of ``delay`` and its own width; write
    ``read_window_counts`` to a table now and then and remove the folders it covers, if the stream runs for long.
    """
    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number:012d}")

    writer = counts.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def read_window_counts(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """The last state of every window written by ``start_window_counts``."""
    rows = spark.read.parquet(path).drop("batch")
    by = ["window_start", "window_end", *keys]
    values = [c for c in rows.columns if c not in (*by, "_batch")]
    latest = rows.groupBy(*by).agg(F.max_by(F.struct(*values), "_batch").alias("_v"))
    return latest.select(*by, *[F.col("_v")[c].alias(c) for c in values])

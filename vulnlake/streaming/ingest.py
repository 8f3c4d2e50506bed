"""Incremental ingestion: new document files in a folder are appended to bronze as they arrive.

The batch scan (``sources.scan_documents``) rereads the whole folder on every run, as the analysed job does.
This is the same scan, flatten and stamp (S1-S3) as a Structured Streaming query over the file source:
each trigger picks up only files not seen before (tracked in the checkpoint), and the parquet file sink
commits each micro-batch exactly once through its metadata log, so a restarted or failed run neither loses
nor duplicates documents. Rejected (unparsable) documents go to their own sink.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import with_ingest_metadata
from ..sources.documents import _with_scan_options, split_documents

DEFAULT_KEYS = ("containers", "cveMetadata", "dataType", "dataVersion")


def stream_documents(spark: SparkSession, source_dir: str, layout: str = "file", year: int | None = None,
                     max_files_per_trigger: int | None = None, keys=None):
    """Streaming counterpart of ``scan_documents``: ``(good, rejected)`` streaming DataFrames."""
    reader = _with_scan_options(spark.readStream.format("text"), layout, year, None)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return split_documents(reader.load(source_dir), layout, keys)


def start_bronze_stream(spark: SparkSession, source_dir: str, bronze_path: str, rejected_path: str | None = None,
                        checkpoint_root: str | None = None, keys=DEFAULT_KEYS, layout: str = "file",
                        year: int | None = None, max_files_per_trigger: int | None = None,
                        available_now: bool = True) -> list[StreamingQuery]:
    """Start the ingest queries (``availableNow``: process everything new, then stop; otherwise run
    continuously). Every sink has its own checkpoint, by default beside the bronze table
    (``<bronze_path>-checkpoint``); rejected documents have one there too."""
    checkpoint_root = checkpoint_root or bronze_path.rstrip("/") + "-checkpoint"
    cols, rejected = stream_documents(spark, source_dir, layout, year, max_files_per_trigger, keys=keys)
    source_year = year if year is not None else F.substring(F.get_json_object("cveMetadata", "$.cveId"), 5, 4)
    # ids must stay unique across micro-batches, so derive them from the document's file and text
    bronze = with_ingest_metadata(cols, source_year, record_id=F.xxhash64("source_file", *keys)).drop("source_file")

    def sink(df, path, name):
        writer = (df.writeStream.format("parquet").option("path", path)
                  .option("checkpointLocation", os.path.join(checkpoint_root, name)))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()

    queries = [sink(bronze, bronze_path, "bronze")]
    if rejected_path:
        queries.append(sink(rejected, rejected_path, "rejected"))
    return queries


def run_available(queries: list[StreamingQuery]) -> None:
    """Block until ``availableNow`` queries have drained their input."""
    for q in queries:
        q.awaitTermination()

"""Document sources: scan a tree of JSON documents (S1), flatten to bronze columns (S2), stamp ingest
metadata (S3).

The scan is one lazy, distributed read: every file (or line) becomes a row on an executor, so the driver
never holds a document. One-file-per-document trees are listed by tasks, folder by folder, and the names kept in the
shared scratch folder, so the driver does not hold the names either.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import documents as J
from ..session import scratch_path

MAX_KEYS = 10_000  # more top-level keys than this are refused (they would be columns), never cut
EMPTY_FILE = "empty file"
LIST_ROWS = 50_000  # names of a folder that are passed on at once
TASK_FILES, TASK_BYTES = 2_000, 64 << 20  # what a task reads: about so many files, or so much
BATCH_FILES, BATCH_BYTES = 512, 8 << 20  # what it holds of them at once, and one file more
NOT_A_DOCUMENT = "not exactly one JSON object"  # text that the parser takes, but no object of its own


def scan_documents(spark: SparkSession, path: str, year: int | None = None, layout: str = "file",
                   name_glob: str | None = None, keys=None, max_records: int | None = None,
                   listing: Listing | None = None) -> tuple[DataFrame, DataFrame]:
    """Read JSON documents below ``path`` recursively; return ``(good, rejected)``.

    ``layout="file"``: one document per file, which may span lines; with ``year`` only names matching
    ``*CVE-{year}-*.json`` are read, otherwise every ``*.json``. ``layout="lines"``: one document per line
    (splittable input, e.g. compacted archives); ``name_glob`` filters file names in both layouts.

    ``good`` has ``value`` (document text) and ``source_file``; with ``keys`` its rows come back already
    flattened to those top-level keys (as ``to_bronze_columns`` would), from the parse that checks the
    document. ``max_records`` keeps that many good documents at most, whichever come first; rejected ones do not
    count towards it. ``rejected`` has ``source_file``, ``value`` (the whole text) and ``error_text`` (what the parser says).
    Files of zero bytes, which Spark's text source skips, are among the rejected (from a listing, unread).

    The tree of ``layout="file"`` is listed when this is called; ``listing`` (from ``list_files`` of the same path) spares that
    where a tree is scanned several times.
    """
    reader = _with_scan_options(spark.read.format("text"), layout, year, name_glob)
    if layout == "file":
        listing = listing if listing is not None else list_files(spark, path)
        own = listing is not None and _glob_pattern(_name_glob(layout, year, name_glob)) is not None
        text = _read_files(listing, _name_glob(layout, year, name_glob)) if own else reader.load(path)
        good, rejected = split_documents(text, layout, keys)
        rejected = rejected.unionByName(empty_files(spark, path, year, name_glob, listing))
    else:
        good, rejected = split_documents(reader.load(path), layout, keys)
    return good if max_records is None else good.limit(max_records), rejected


class Listing(NamedTuple):
    """The files below a folder: rows ``file`` (path as the file system has it) and ``size``, staged in the shared folder."""

    files: DataFrame
    uri: str
    base: str


def list_files(spark: SparkSession, path: str) -> Listing | None:
    """The files below the folder ``path``, one job per level of folders: each folder is listed by a task, and what it finds
    is written to the shared scratch folder. Names that Spark passes over (``_x``, ``.x``) are passed over here.

    None where tasks cannot list it (a pattern, a single file, a file system that pyarrow does not know): then Spark's reader
    does, whose listing the driver holds.
    """
    try:
        fs, base = pafs.FileSystem.from_uri(path)
        odd = any(c in path for c in "*?[{") or ("%" in path and not path.startswith("/"))  # Spark takes % in a URI as it stands
        known = not odd and fs.get_file_info(base).type == pafs.FileType.Directory
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        known = False
    if not known:
        return None

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, _ = pafs.FileSystem.from_uri(path)
        for folder in (f for b in batches for f in b.column(0).to_pylist()):
            found = [i for i in here.get_file_info(pafs.FileSelector(folder)) if not _passed_over(i.base_name)]
            for k in range(0, len(found), LIST_ROWS):
                part = found[k:k + LIST_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.path for i in part], pa.string()), pa.array([i.size for i in part], pa.int64()),
                     pa.array([i.type == pafs.FileType.Directory for i in part], pa.bool_())], ["file", "size", "is_folder"])

    root, levels = scratch_path(spark, "listing"), []
    folders, n = spark.createDataFrame([(base,)], "file string"), 1
    while n:
        dealt = folders.repartition(min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file")
        levels.append(f"{root}/{len(levels)}")
        schema = "file string, size bigint, is_folder boolean"
        dealt.mapInArrow(found_in, schema).write.option("compression", "zstd").parquet(levels[-1])
        folders = spark.read.schema(schema).parquet(levels[-1]).where("is_folder").select("file")
        n = folders.count()
    return Listing(spark.read.schema(schema).parquet(*levels).where("not is_folder").select("file", "size"), path, base)


def _passed_over(name: str) -> bool:
    """As Spark's listing does it."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _glob_pattern(glob: str) -> str | None:
    """A name pattern of ``*`` and ``?`` as a regular expression over paths; None for richer ones."""
    if any(c in glob for c in "[]{}\\"):
        return None
    return r"(?s)(^|/)" + "".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in glob) + r"\z"


def _source_files(listing: Listing, empty: bool = False) -> Column:
    """The names of files as Spark writes them: a URI, with what a URI cannot hold escaped. Local ones begin with ``file:/`` in
    ``_metadata.file_path`` and with ``file:///`` in ``inputFiles()``, from where empty files were taken."""
    rest = F.substring("file", len(listing.base) + 1, 1 << 30)
    local = listing.uri.startswith(("/", "file:"))
    whole = F.col("file") if local else rest
    for c in "%" + ' "#<>?[\\]^`{|}':
        whole = F.replace(whole, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.concat(F.lit(("file://" if empty else "file:") if local else listing.uri.rstrip("/")), whole)


def _read_files(listing: Listing, glob: str) -> DataFrame:
    """The files of a listing whose names match, as Spark's text source gives whole files: ``value`` and ``_metadata.file_path``."""
    uri = listing.uri

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(uri)
        names, texts, held = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], ["file_path", "value"])

        for file, name in ((f, n) for b in batches for f, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            with fs.open_input_stream(file) as f:
                texts.append(f.read())
            names.append(name)
            held += len(texts[-1])
            if len(texts) >= BATCH_FILES or held >= BATCH_BYTES:
                yield batch()
                names, texts, held = [], [], 0
        if texts:
            yield batch()

    files = listing.files.where(F.col("size") > 0).where(F.col("file").rlike(_glob_pattern(glob)))
    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    dealt = files.repartition(max(1, -(-n // TASK_FILES), -(-size // TASK_BYTES)), "file")
    texts = dealt.select("file", _source_files(listing).alias("file_path")).mapInArrow(read, "file_path string, value binary")
    return texts.select(F.col("value").cast("string").alias("value"), F.struct("file_path").alias("_metadata"))


def empty_files(spark: SparkSession, path: str, year: int | None = None, name_glob: str | None = None,
                listing: Listing | None = None) -> DataFrame:
    """The files of zero bytes below ``path``, as rejected documents: those that are listed but come in no scan, which
    passes over empty files. No content is read; the names come from the listing that tasks make (``list_files``), or, where they
    cannot, from the one that the driver holds for any scan of files."""
    listing = listing if listing is not None else list_files(spark, path)
    pattern = _glob_pattern(_name_glob("file", year, name_glob))
    if listing is not None and pattern is not None:
        return listing.files.where(F.col("size") == 0).where(F.col("file").rlike(pattern)).select(
            _source_files(listing, empty=True).alias("source_file"), F.lit("").alias("value"), F.lit(EMPTY_FILE).alias("error_text"))
    listed = _with_scan_options(spark.read.format("binaryFile"), "file", year, name_glob).load(path)
    names = pa.table({"source_file": pa.array(listed.inputFiles(), pa.string())})
    scanned = listed.select(F.input_file_name().alias("source_file"))
    return spark.createDataFrame(names).join(scanned, "source_file", "left_anti").select(
        "source_file", F.lit("").alias("value"), F.lit(EMPTY_FILE).alias("error_text"))


def _name_glob(layout: str, year: int | None, name_glob: str | None) -> str | None:
    return name_glob or (f"*CVE-{year}-*.json" if (layout == "file" and year is not None)
                         else ("*.json" if layout == "file" else None))


def _with_scan_options(reader, layout: str, year: int | None, name_glob: str | None):
    """Shared by the batch and the streaming scan: recursive listing, name filter, whole-file rows."""
    if layout not in ("file", "lines"):
        raise ValueError(f"layout must be 'file' or 'lines', not {layout!r}")
    glob = _name_glob(layout, year, name_glob)
    reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.option("wholetext", "true") if layout == "file" else reader


def parse_documents(text: DataFrame, layout: str = "file", keys=None) -> DataFrame:
    """Rows of a text scan -> ``source_file``, ``value``, ``is_document`` and the top-level ``keys`` as text.

    A document is exactly one JSON object, with any JSON white space around it. The text is parsed once, as
    the only element of an array inside an array: text behind the object either breaks the parse or adds an
    element.
    """
    raw = text.select("value", F.col("_metadata.file_path").alias("source_file"))
    if layout == "lines":
        raw = raw.filter(F.length(F.trim("value")) > 0)
    schema = T.ArrayType(T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in (keys or ())]
                                                  or [T.StructField("_", T.StringType())])))
    wrapped = F.from_json(F.concat(F.lit("[["), F.col("value"), F.lit("],[]]")), schema)
    parsed = J.with_parsed(raw, wrapped, "_doc")
    first = F.get(F.col("_doc"), 0)
    ok = ((F.size("_doc") == 2) & (F.size(first) == 1) & F.get(first, 0).isNotNull()
          & F.rtrim("value", F.lit(" \t\r\n")).endswith("}"))
    return parsed.select("source_file", "value", F.coalesce(ok, F.lit(False)).alias("is_document"),
                         *[F.get(first, 0)[k].alias(k) for k in (keys or ())])


def split_documents(text: DataFrame, layout: str = "file", keys=None) -> tuple[DataFrame, DataFrame]:
    """``parse_documents`` as ``(good, rejected)``; see ``scan_documents`` for their columns."""
    parsed = parse_documents(text, layout, keys)
    good = parsed.filter("is_document").select("source_file", *(keys or ["value"]))
    return good, rejected_documents(parsed)


def rejected_documents(parsed: DataFrame) -> DataFrame:
    """The rows that are no documents: ``source_file``, ``value`` and ``error_text``, what a JSON parser says of the text."""
    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([parse_error(t) for t in b.column(1).to_pylist()], pa.string())],
                                             ["source_file", "value", "error_text"])

    bad = parsed.filter("not is_document").select("source_file", "value")
    return bad.mapInArrow(explain, "source_file string, value string, error_text string")


def parse_error(text: str | None) -> str:
    """Why a rejected text is no document."""
    try:
        found = json.loads(text or "")
    except (ValueError, RecursionError) as e:
        return str(e)
    return NOT_A_DOCUMENT if isinstance(found, dict) else f"{NOT_A_DOCUMENT}: {type(found).__name__}"


def discover_keys(docs: DataFrame, value_col: str = "value", max_keys: int = MAX_KEYS) -> list[str]:
    """Union of top-level keys over all documents, sorted. More than ``max_keys`` is an error: they would
    become columns."""
    rows = (docs.select(F.explode(F.json_object_keys(value_col)).alias("k")).distinct().orderBy("k").limit(max_keys + 1).collect())
    if len(rows) > max_keys:
        raise ValueError(f"more than {max_keys} distinct top-level keys; pass keys=")
    return [r["k"] for r in rows]


def to_bronze_columns(docs: DataFrame, keys=None, value_col: str = "value", keep=()) -> DataFrame:
    """One column per top-level key, every value as text: objects and arrays become their JSON text,
    scalars their text, JSON null and absent keys NULL. ``keys=None`` discovers the key union first."""
    keys = list(keys) if keys is not None else discover_keys(docs, value_col)
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    parsed = J.with_parsed(docs, F.from_json(F.col(value_col), schema), "_doc")
    return parsed.select(*[F.col(c) for c in keep], *[F.col("_doc")[k].alias(k) for k in keys])


def with_ingest_metadata(df: DataFrame, year: int | Column, ingested_at=None, record_id: Column | None = None
                         ) -> DataFrame:
    """Add ``_ingestion_timestamp``, ``_ingestion_date``, ``_source_year`` and ``_record_id``.

    ``ingested_at`` (datetime or ISO text) pins the timestamp for reproducible loads; default is the
    query's ``current_timestamp()``. The default ``_record_id`` is unique within one load but neither dense
    nor stable across runs; pass ``record_id`` (e.g. a content hash) where loads are appended.
    """
    if ingested_at is None:
        ts, day = F.current_timestamp(), F.current_date()
    else:
        if isinstance(ingested_at, _dt.datetime):
            ingested_at = ingested_at.strftime("%Y-%m-%d %H:%M:%S")
        ts = F.to_timestamp(F.lit(str(ingested_at)))
        day = F.to_date(ts)
    # a year derived from document text may be garbage: NULL it rather than fail the load (ANSI cast)
    year_col = year.try_cast("int") if isinstance(year, Column) else F.lit(int(year))
    return (df.withColumn("_ingestion_timestamp", ts)
              .withColumn("_ingestion_date", day)
              .withColumn("_source_year", year_col)
              .withColumn("_record_id", F.monotonically_increasing_id() if record_id is None else record_id))

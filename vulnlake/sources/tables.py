"""Table sinks and read-back (S4), CSV export (S5), table profile and preview (S6)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MERGING = ("parquet", "orc")  # formats that read files of several schemas as one


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def write_table(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite",
                schema: str = "replace", partition_by=None, bucket_by: tuple[int, list] | None = None,
                sort_by=None, max_records_per_file: int | None = None, compression: str | None = None) -> None:
    """Write ``df`` to a managed table (``db.name``) or a storage path; rerunnable with ``mode="overwrite"``.

    ``schema="replace"`` lets the table change shape on overwrite (what parquet overwrite already does).
    ``schema="merge"`` keeps the columns that the table has and adds those it lacks: with ``mode="overwrite"`` the
    old columns are there and NULL, with ``mode="append"`` each load has NULL in what it lacks (read a path back with
    ``read_table(..., merge_schema=True)``). A column whose type differs is refused. Delta merges by itself; of the other
    formats, parquet and orc can. ``bucket_by=(n, cols)``
    (tables only) co-locates later joins/aggregations on ``cols`` without a shuffle. ``max_records_per_file``
    rolls each task's output over to a new file every N rows (after a sort, each file covers a narrow range).
    ``compression`` picks the file codec (e.g. ``zstd``: about half the size of snappy on JSON-heavy bronze).
    """
    if schema not in ("replace", "merge"):
        raise ValueError(f"schema must be 'replace' or 'merge', not {schema!r}")
    if schema == "merge" and fmt != "delta":
        df = _merged(df, target, fmt, mode)
    writer = df.write.format(fmt).mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(int(max_records_per_file)))
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "delta":
        writer = writer.option("overwriteSchema" if schema == "replace" else "mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if _is_path(target):
        if bucket_by:
            raise ValueError("bucketing needs a catalog table, not a path")
        writer.save(target)
        return
    if bucket_by:
        n, cols = bucket_by
        cols = [cols] if isinstance(cols, str) else list(cols)
        writer = writer.bucketBy(n, *cols)
        if sort_by:
            writer = writer.sortBy(*([sort_by] if isinstance(sort_by, str) else sort_by))
    if "." in target:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {target.rsplit('.', 1)[0]}")
    writer.saveAsTable(target)


def table_schema(spark: SparkSession, target: str, fmt: str = "parquet") -> T.StructType | None:
    """The columns of a table, of all its loads, or None where there is no table."""
    try:
        return read_table(spark, target, fmt, merge_schema=fmt in MERGING).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND"):
            return None
        raise


def _merged(df: DataFrame, target: str, fmt: str, mode: str) -> DataFrame:
    """``df`` with the columns that the table has and it lacks, in the table's order; a named table that is appended to gets
    the columns that it lacks."""
    if fmt not in MERGING:
        raise ValueError(f"{fmt} tables cannot merge schemas")
    spark = df.sparkSession
    have = table_schema(spark, target, fmt)
    if have is None:
        return df
    own = {f.name: f for f in df.schema}
    differ = [f.name for f in have if f.name in own and own[f.name].dataType != f.dataType]
    if differ:
        raise ValueError(f"the table has other types for {', '.join(differ)}")
    new = [f for f in df.schema if f.name not in have.names]
    if mode == "append" and new and not _is_path(target):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({columns})")
    return df.select(*[F.col(f"`{f.name}`") if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in have],
                     *[F.col(f"`{f.name}`") for f in new])


def read_table(spark: SparkSession, target: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Read a table by name or by storage path. ``merge_schema``: a path's columns are those of all its files, not of
    one of them (every file's footer is read)."""
    if _is_path(target):
        return spark.read.format(fmt).options(**({"mergeSchema": "true"} if merge_schema else {})).load(target)
    return spark.table(target)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a result set as CSV with a header. ``single_file`` is for small (report-sized) results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def table_profile(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` (one distributed count), ``n_columns`` and ``schema_ddl`` (from the plan)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(df.schema.simpleString()).alias("schema_ddl"))


def preview(df: DataFrame, n: int = 5, max_cols: int = 10, truncate: int = 200) -> DataFrame:
    """The first ``max_cols`` columns of ``n`` rows, each rendered as text cut to ``truncate`` characters."""
    cols = df.columns[:max_cols]
    return df.select(*[F.substring(F.col(c).cast("string"), 1, truncate).alias(c) for c in cols]).limit(n)

"""A training-data pipeline over ``documents``: every stage is one operator of ``vulnlake.llm``, works on what
its predecessor kept, and its decisions take effect. All stages but the last return the columns of documents.

Defined cases of every stage: null texts count as empty and stay null where they stay; rows without an id are judged by their
text like any other and are never dropped for want of an id; repeated rows and ties are as each stage says; texts of any
length are read whole; an empty table gives an empty result; columns beside doc_id, text and n_chars are carried along,
whatever their names, and need not be there.
"""

from __future__ import annotations

import functools
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:  # importable however this file is loaded
    sys.path.insert(0, _HERE)

from vulnlake.llm.common import free_name, scratch_path, small_batches, stored, table  # noqa: E402
from vulnlake.llm.decontaminate import contamination  # noqa: E402
from vulnlake.llm.near_dedup import keep_one_each  # noqa: E402
from vulnlake.llm.packing import pack  # noqa: E402
from vulnlake.llm.quality import keep_good  # noqa: E402
from vulnlake.llm.secret_ledger import redact  # noqa: E402
from vulnlake.session import apply_defaults  # noqa: E402


def in_small_batches(stage):
    """The stage, with rows going to Python in small Arrow batches."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trees score below 0.5 go; repeated rows are scored alike, so all of them go or stay."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id. Texts without words are near nothing
    and stay."""
    return keep_one_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; they are known by id and text, so repeated rows go together."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    by_id, by_hash = free_name(docs, "bad_id"), free_name(docs, "bad_hash")
    bad = stored(found.where("contaminated").select(F.col("doc_id").alias(by_id), F.col("text_hash").alias(by_hash)).distinct(), "contaminated")
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(by_id)) & (F.xxhash64("text") == F.col(by_hash)), "left_anti")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark, and n_chars, if it is there, counts what is left; the documents stay."""
    clean = redact(docs, scratch_path(spark, "pipeline-ledger"))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(clean.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the surviving documents: its sequence and its place there."""
    return pack(docs)


STAGES = [(name, in_small_batches(stage)) for name, stage in [
    ("quality classifier", quality_classifier),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]]

# Trained trees, components and packing have no SQL form; tests hold every stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each stage's result is written to the shared folder and read again."""
    apply_defaults(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

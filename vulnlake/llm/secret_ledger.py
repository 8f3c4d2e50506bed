"""Secret scans over an incremental blob ledger.

Every historical version of a file is addressed by the SHA-256 of its text. The ledger is a Parquet table
``(blob, rule_version, spans)``: a run scans only the blobs that the ledger lacks for the current rule
version, appends their findings, and joins the ledger back to all paths that hold the blob. A blob with a
million copies is scanned once; the copies are collapsed map-side before the text is shuffled, and the way
back is an equi-join on the blob address whose large side adaptive execution can split.

Defined cases: null text is the empty text; equal texts share one ledger row, and a blob that two runs at once have both
appended is read once; repeated rows keep one result row each; texts of any length are scanned whole, in time
proportional to their length; an empty table gives an empty result; other columns are ignored (by ``redact``: kept), whatever
their names. Offsets count code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_batches, scratch_path, slices, stored, table, text_or_empty

# The base rules (kind, pattern, group whose length counts, least length), in listed order.
BASE_RULES = (
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),  # a run of [0-9a-f]+ that is long enough
)
# Rules this operator adds.
EXTRA_RULES = (
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}", 0, 29),  # from the start of a run only
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 20),
)
RULES = BASE_RULES + EXTRA_RULES
RULE_VERSION = "3"
SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"
LEDGER_SCHEMA = f"blob string, rule_version string, spans {SPANS}"
HIT_KEYS = 1 << 21  # short keys of the blobs with findings, broadcast by ``redact``: about 70 MB if all occur


def find_secrets(text: str, rules=RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every match that is long enough, by start, then rule order."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(rules):
        for m in re.finditer(pattern, text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, kind, m.end()))
    found.sort()
    return [(kind, start, end) for start, _, kind, end in found]


def scan_blobs(blobs: DataFrame, rules=RULES, rule_version: str = RULE_VERSION) -> DataFrame:
    """``(blob, text)`` -> ledger rows."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in slices(batches):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t, rules)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([rule_version] * b.num_rows, pa.string()), pa.array(spans, kind)], ["blob", "rule_version", "spans"])

    return map_batches(blobs.select("blob", "text"), scan, LEDGER_SCHEMA)


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger, one row per blob and rule version (two runs at once may have appended the same one, with the same
    findings); an empty table where no run has written yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path).dropDuplicates(["blob", "rule_version"])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def address(text_col: str = "text") -> Column:
    return F.sha2(text_or_empty(text_col).cast("binary"), 256)


def update_ledger(versions: DataFrame, ledger_path: str, text_col: str = "text", rules=RULES,
                  rule_version: str = RULE_VERSION) -> DataFrame:
    """Scan the blobs of ``versions`` that the ledger lacks for ``rule_version``; returns the ledger.

    The append is one Spark job and commits as a whole; a run that is repeated finds nothing unseen.
    """
    spark = versions.sparkSession
    blobs = versions.select(address(text_col).alias("blob"), text_or_empty(text_col).alias("text"))
    seen = read_ledger(spark, ledger_path).where(F.col("rule_version") == rule_version).select("blob")
    # copies collapse map-side before anything else is joined
    unseen = blobs.groupBy("blob").agg(F.first("text").alias("text")).join(seen, "blob", "left_anti")
    scan_blobs(unseen, rules, rule_version).write.mode("append").parquet(ledger_path)
    return read_ledger(spark, ledger_path)


def findings(versions: DataFrame, ledger: DataFrame, path_col: str, text_col: str = "text",
             rule_version: str = RULE_VERSION) -> DataFrame:
    """``(path_col, spans)`` for every row of ``versions``; ``spans`` is empty where nothing was found."""
    hits = ledger.where((F.col("rule_version") == rule_version) & (F.size("spans") > 0)).select("blob", "spans")
    return (versions.select(path_col, address(text_col).alias("blob")).join(hits, "blob", "left")
            .select(path_col, F.coalesce("spans", F.array().cast(SPANS)).alias("spans")))


def redact(docs: DataFrame, ledger_path: str, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span (overlapping ones merged) replaced by ``mark``; other columns stay. Only texts with
    findings are shuffled and leave the JVM, and those that share a short key with one of them are shuffled with them: the
    distinct keys, at most ``HIT_KEYS``, are broadcast, so all other texts stay where they are read. ``docs`` is read for each part."""
    ledger = update_ledger(docs, ledger_path, text_col)
    blob, key, starts, ends = (free_name(docs, c) for c in ("blob", "hit_key", "starts", "ends"))
    hits = stored(ledger.where((F.col("rule_version") == RULE_VERSION) & (F.size("spans") > 0)).select(
        F.col("blob").alias(blob), F.col("spans.start").alias(starts), F.col("spans.end").alias(ends)), "secret-hits")
    short = F.pmod(F.xxhash64(blob), F.lit(HIT_KEYS))
    keys = F.broadcast(hits.select(short.alias(key)).distinct())

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        out = []
        for text, begin, end in zip(texts, starts, ends):
            parts, at = [], 0
            for a, z in zip(begin, end) if text is not None else ():  # by start
                if a > at or not parts:
                    parts += [text[at:a], mark]
                    at = z
                else:
                    at = max(at, z)
            out.append(None if text is None else "".join(parts) + text[at:])
        return pd.Series(out, dtype=object)

    addressed = docs.withColumn(blob, address(text_col)).withColumn(key, short)
    found = addressed.join(keys, key, "left_semi").join(hits, blob, "left")
    hit = F.col(starts).isNotNull()
    clean = cut(F.when(hit, F.col(text_col)), F.col(starts), F.col(ends))
    found = found.withColumn(text_col, F.when(hit, clean).otherwise(F.col(text_col)))
    return found.select(*docs.columns).union(addressed.join(keys, key, "left_anti").select(*docs.columns))


def secret_report(docs: DataFrame, ledger_path: str) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: the counts of base findings, their digest and all spans as text. Scans what the
    ledger lacks."""
    found = findings(docs, update_ledger(docs, ledger_path), "doc_id")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*[r[0] for r in BASE_RULES]))
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op7_secret_ledger(spark, sf_dir: str) -> DataFrame:
    """All documents against a new ledger; ``secret_report`` over a kept one scans only what is new."""
    return secret_report(table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))

"""Bronze -> silver transforms (T1-T12).

The core table is one projection of built-in JSON and higher-order functions followed by exactly one
shuffle (the duplicate merge, with map-side partial aggregation); the affected table is a projection and a
generator with no shuffle at all.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import documents as J
from ..functions import scores as SC

MERGE_KEYS = ("cve_id", "publication_state", "assigning_org_id", "assigning_org_name",
              "published_timestamp", "reserved_timestamp", "updated_timestamp", "cve_description",
              "bronze_ingestion_ts", "data_year")


def _literal_ts(at) -> Column:
    if isinstance(at, _dt.datetime):
        at = at.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp(F.lit(str(at)))


# ---- T1 / T2 -------------------------------------------------------------------------------------

def extract_json_columns(df: DataFrame, src: str, paths: dict, keep: dict | None = None) -> DataFrame:
    """Named columns from JSON paths of ``src`` (``{name: "$.path"}``) plus renamed pass-through columns
    (``{new_name: existing_column}``)."""
    keep = keep or {}
    return df.select(*[F.col(old).alias(new) for new, old in keep.items()],
                     *[J.json_path(src, path).alias(name) for name, path in paths.items()])


def normalize_timestamps(df: DataFrame, cols, strict: bool = False) -> DataFrame:
    """ISO-8601 text columns to timestamps in place; unparsable values become NULL (``strict`` raises)."""
    return df.withColumns({c: J.parse_timestamp(c, strict) for c in cols})


# ---- T3 ------------------------------------------------------------------------------------------

def pick_language(df: DataFrame, json_col: str, path: str = "$.cna.descriptions", lang: str = "en",
                  out: str = "cve_description") -> DataFrame:
    """First value with exactly ``lang`` (``en-US`` does not match) from an array of ``{lang, value}``."""
    return df.withColumn(out, J.language_from_json(J.json_path(json_col, path), lang))


# ---- T4 / T5 -------------------------------------------------------------------------------------

def _part(container: str, field: str) -> str:
    return f"_{container}_{field}"


_FIELDS = ("baseScore", "baseSeverity", "vectorString")


def score_parts(df: DataFrame, metrics_json: Column, versions=S.CVSS_VERSIONS) -> DataFrame:
    """Per-row maxima of score, severity and vector for every CVSS container of a JSON metrics array
    (strings compare lexicographically, so e.g. {CRITICAL, MEDIUM} -> MEDIUM)."""
    containers = [c for _, c in versions]
    paths = [(c, f) for c in containers for f in _FIELDS]
    types = ["double" if f == "baseScore" else "string" for _, f in paths]
    folded = df.withColumn("_parts", J.max_fields(J.parse_metrics(metrics_json, containers), paths, types))
    return folded.withColumns({_part(c, f): F.col("_parts")[f"{c}_{f}"] for c, f in paths}).drop("_parts")


def finalize_scores(df: DataFrame, versions=S.CVSS_VERSIONS) -> DataFrame:
    """Fold per-version parts into ``cvss_base_score``, ``cvss_severity_rating``, ``cvss_vector`` (each falls
    back on its own) and ``cvss_version_used`` (follows the score alone)."""
    containers = [c for _, c in versions]
    labels = [v for v, _ in versions]
    scores = [F.col(_part(c, "baseScore")) for c in containers]
    out = df.withColumns({
        "cvss_base_score": SC.first_present(scores),
        "cvss_severity_rating": SC.first_present([F.col(_part(c, "baseSeverity")) for c in containers]),
        "cvss_vector": SC.first_present([F.col(_part(c, "vectorString")) for c in containers]),
        "cvss_version_used": SC.version_label(scores, labels),
    })
    return out.drop(*[_part(c, f) for c in containers for f in _FIELDS])


def consolidate_scores(df: DataFrame, json_col: str, path: str = "$.cna.metrics",
                       versions=S.CVSS_VERSIONS) -> DataFrame:
    """Per-document CVSS consolidation (no merge across rows)."""
    return finalize_scores(score_parts(df, J.json_path(json_col, path), versions), versions)


def merge_duplicates(df: DataFrame, keys=MERGE_KEYS, versions=S.CVSS_VERSIONS) -> DataFrame:
    """Collapse rows equal on ``keys`` taking the max of every score part (one exchange; partial
    aggregation map-side, so even a hot key ships at most one row per map task). ``max`` of text has no hash
    buffer, so both sides of the exchange are sorted aggregations over the keys; they spill when they must. A hash of
    the keys is the first of them: it decides nearly every comparison of the sorts, where ids share their beginning."""
    parts = [_part(c, f) for _, c in versions for f in _FIELDS]
    hashed = df.withColumn("_keys_hash", F.xxhash64(*keys))
    return hashed.groupBy("_keys_hash", *keys).agg(*[F.max(p).alias(p) for p in parts]).drop("_keys_hash")


# ---- T6-T9 ---------------------------------------------------------------------------------------

def with_presence_flags(df: DataFrame, flags: dict) -> DataFrame:
    """``{flag: column}`` -> boolean not-null flags (take them before defaults are filled)."""
    return df.withColumns({flag: F.col(c).isNotNull() for flag, c in flags.items()})


def with_band(df: DataFrame, col: str = "cvss_base_score", out: str = "risk_category", bands=S.RISK_BANDS,
              default: str = S.RISK_DEFAULT) -> DataFrame:
    return df.withColumn(out, SC.band(col, bands, default))


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """``{column: value}`` for NULLs; defaults for columns the frame does not have are skipped."""
    present = {c: v for c, v in defaults.items() if c in df.columns}
    return df.fillna(present) if present else df


def with_processing_time(df: DataFrame, at=None, out: str = "silver_transform_timestamp") -> DataFrame:
    return df.withColumn(out, F.current_timestamp() if at is None else _literal_ts(at))


# ---- T10 / T11 -----------------------------------------------------------------------------------

def explode_json_objects(df: DataFrame, json_col: str, path: str | None = None, out: str = "item",
                         keep=()) -> DataFrame:
    """Rows with non-null JSON text at ``path`` -> one row per object of the array (``explode_outer``: an
    empty array or a non-array value yields one NULL item)."""
    text = J.json_path(json_col, path) if path else F.col(json_col)
    keep_cols = [F.col(k) if isinstance(k, str) else k for k in keep]
    # a generator over the texts that exist: the path is read once and NULLs make no row
    staged = df.select(*keep_cols, F.explode(F.filter(F.array(text), lambda t: t.isNotNull())).alias("_json_text"))
    kept = [c for c in staged.columns if c != "_json_text"]
    return staged.select(*kept, F.explode_outer(J.parse_objects("_json_text")).alias(out))


def affected_products(bronze: DataFrame, at=None, meta_col: str = "cveMetadata",
                      containers_col: str = "containers") -> DataFrame:
    """One row per affected entry with a vendor; product/status defaults filled."""
    items = explode_json_objects(bronze, containers_col, "$.cna.affected",
                                 keep=[J.json_path(meta_col, "$.cveId").alias("cve_id")])
    projected = items.select("cve_id", *[F.col("item")[key].alias(name) for name, key in S.AFFECTED_FIELDS.items()])
    return fill_defaults(with_processing_time(projected.filter(F.col("vendor_name").isNotNull()), at),
                         S.AFFECTED_DEFAULTS)


# ---- T12 -----------------------------------------------------------------------------------------

def core_rows(bronze: DataFrame, lang: str = "en", versions=S.CVSS_VERSIONS, strict_timestamps: bool = False,
              meta_col: str = "cveMetadata", containers_col: str = "containers") -> DataFrame:
    """Per-document core fields and per-version score parts, before the merge (no shuffle)."""
    parsed = J.with_parsed(bronze, F.from_json(F.col(meta_col), S.META_SCHEMA), "_meta")
    parsed = J.with_parsed(parsed, F.from_json(F.col(containers_col), S.CNA_SCHEMA)["cna"], "_cna")
    meta, cna = F.col("_meta"), F.col("_cna")
    rows = parsed.select(
        *[meta[field].alias(name) for name, field in S.META_FIELDS.items()],
        *[J.parse_timestamp(meta[field], strict_timestamps).alias(name) for name, field in S.TIME_FIELDS.items()],
        J.language_from_json(cna["descriptions"], lang).alias("cve_description"),
        F.col("_ingestion_timestamp").alias("bronze_ingestion_ts"),
        F.col("_source_year").alias("data_year"),
        cna["metrics"].alias("_metrics_json"),
    )
    return score_parts(rows, F.col("_metrics_json"), versions).drop("_metrics_json")


def finish_core(merged: DataFrame, at=None, versions=S.CVSS_VERSIONS) -> DataFrame:
    """Scores, processing time, presence flags (before fill), risk band, defaults; canonical column order."""
    out = finalize_scores(merged, versions)
    out = with_processing_time(out, at)
    out = with_presence_flags(out, {"has_description": "cve_description", "has_cvss": "cvss_base_score"})
    out = with_band(out)
    out = fill_defaults(out, S.CORE_DEFAULTS)
    return out.select(*S.CORE_COLUMNS)


def build_core(bronze: DataFrame, at=None, lang: str = "en", versions=S.CVSS_VERSIONS, merge: bool = True,
               strict_timestamps: bool = False) -> DataFrame:
    """Bronze -> ``core_cves`` (18 columns). Rows equal on the ten metadata keys (exact duplicate documents
    of one load) merge; a changed description or update time keeps separate rows."""
    rows = core_rows(bronze, lang, versions, strict_timestamps)
    merged = merge_duplicates(rows, MERGE_KEYS, versions) if merge else rows
    return finish_core(merged, at, versions)


def build_affected(bronze: DataFrame, at=None) -> DataFrame:
    """Bronze -> ``affected_products`` (9 columns)."""
    return affected_products(bronze, at).select(*S.AFFECTED_COLUMNS)

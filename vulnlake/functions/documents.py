"""Column expressions over JSON text and parsed nested values (no explode, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_path(src: str | Column, path: str) -> Column:
    """Text at a JSON path: scalars as text, objects/arrays as JSON text, JSON null or bad JSON as NULL."""
    return F.get_json_object(col_of(src), path)


def with_parsed(df: DataFrame, parsed: Column, out: str) -> DataFrame:
    """``df`` with ``parsed`` as column ``out``, evaluated once per row: a one-element generator keeps the
    optimizer from copying the parse into every place that reads one of its fields."""
    return df.select("*", F.explode(F.array(parsed)).alias(out))


def parse_timestamp(text: str | Column, strict: bool = False) -> Column:
    """ISO-8601 text (zone optional, date-only allowed) to a timestamp; unparsable text is NULL unless strict."""
    c = col_of(text)
    return F.to_timestamp(c) if strict else F.try_to_timestamp(c)


def first_in_language(descriptions: str | Column, lang: str = "en") -> Column:
    """Value of the first entry with exactly ``lang`` and a non-null value, in array order; NULL if none."""
    arr = col_of(descriptions)
    hits = F.filter(arr, lambda d: (d["lang"] == F.lit(lang)) & d["value"].isNotNull())
    return F.get(hits, 0)["value"]


def language_from_json(json_text: str | Column, lang: str = "en") -> Column:
    return first_in_language(F.from_json(col_of(json_text), S.DESCRIPTION_SCHEMA), lang)


def max_field(entries: Column, container: str, field: str) -> Column:
    """Max of ``entry.container.field`` over an array of metric entries (NULLs skipped, strings lexicographic)."""
    return F.array_max(F.transform(entries, lambda m: m[container][field]))


def max_fields(entries: Column, paths, types) -> Column:
    """Per-path maxima over an array in a single traversal: a struct with one field ``<container>_<field>``
    per ``(container, field)`` path. Same values as one ``max_field`` per path, but the array (and the JSON
    it comes from) is evaluated once instead of once per path."""
    names = [f"{c}_{f}" for c, f in paths]
    init = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in zip(names, types)])
    return F.aggregate(entries, init, lambda acc, m: F.struct(
        *[F.greatest(acc[n], m[c][f]).alias(n) for n, (c, f) in zip(names, paths)]))


def parse_metrics(json_text: str | Column, containers=None) -> Column:
    containers = containers or tuple(c for _, c in S.CVSS_VERSIONS)
    return F.from_json(col_of(json_text), S.metrics_schema(containers))


def parse_objects(json_text: str | Column) -> Column:
    """A JSON array of objects as ``array<map<string,string>>``; nested values stay JSON text."""
    return F.from_json(col_of(json_text), S.AFFECTED_SCHEMA)

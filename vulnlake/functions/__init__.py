"""Reusable column expressions (all built-in Spark functions; no UDFs)."""

from .documents import (first_in_language, json_path, language_from_json, max_field, parse_metrics,
                        parse_objects, parse_timestamp)
from .numeric import avg_rounded, count_when, label_at_least, percent, ratio, share_of_total
from .scores import band, first_present, version_label

__all__ = [
    "avg_rounded", "band", "count_when", "first_in_language", "first_present", "json_path",
    "label_at_least", "language_from_json", "max_field", "parse_metrics", "parse_objects",
    "parse_timestamp", "percent", "ratio", "share_of_total", "version_label",
]

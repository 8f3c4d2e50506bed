"""Score banding and version fallback as chained CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S
from .documents import col_of


def band(score: str | Column, bands=S.RISK_BANDS, default: str = S.RISK_DEFAULT) -> Column:
    """Label of the first band whose bound the score meets; ``default`` for NULL and anything below."""
    s = col_of(score)
    expr = None
    for label, bound, op in bands:
        cond = s >= bound if op == ">=" else s > bound
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def first_present(values) -> Column:
    """``COALESCE`` over per-version values, most preferred first."""
    return F.coalesce(*values)


def version_label(scores, labels, none: str = S.NO_VERSION) -> Column:
    """Label of the first version whose score is present, else ``none`` (follows the score alone)."""
    expr = None
    for s, label in zip(scores, labels):
        expr = F.when(s.isNotNull(), label) if expr is None else expr.when(s.isNotNull(), label)
    return expr.otherwise(none)

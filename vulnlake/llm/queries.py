"""The registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_defaults
from .decontaminate import op6_decontamination
from .extract import op2_main_text
from .fingerprint import op5_fingerprint
from .lexical_search import op12_lexical_search
from .lm_score import op10_lm_score
from .near_dedup import op4_near_dedup
from .oracles import ORACLES
from .packing import op3_packing
from .quality import op1_quality
from .secret_ledger import op7_secret_ledger
from .suffix_dedup import op8_suffix_dedup
from .token_counts import op11_token_counts
from .warc import op9_warc
from .whitening import op13_whitening


def _bound(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(apply_defaults(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {fn.__name__: _bound(fn) for fn in (
    op1_quality,
    op2_main_text,
    op3_packing,
    op4_near_dedup,
    op5_fingerprint,
    op6_decontamination,
    op7_secret_ledger,
    op8_suffix_dedup,
    op9_warc,
    op10_lm_score,
    op11_token_counts,
    op12_lexical_search,
    op13_whitening,
)}

__all__ = ["ORACLES", "QUERIES"]

"""The numbered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, exact_dedup, line_dedup, source_mix, spelling
from .alignment import op11_token_alignment
from .chat import op3_chat_format
from .exact_dedup import op9_exact_dedup
from .language_id import op10_language_id
from .line_dedup import op7_line_dedup
from .near_dedup import op1_near_dedup
from .neighbours import op4_neighbours
from .packing import op5_best_fit_packing
from .secret_scan import op8_secret_scan
from .source_mix import op6_source_mix
from .spelling import op13_spelling_variants
from .suffix_dedup import op2_suffix_dedup
from .token_files import op12_token_files


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_near_dedup, op2_suffix_dedup, op3_chat_format, op4_neighbours, op5_best_fit_packing, op6_source_mix, op7_line_dedup, op8_secret_scan,
        op9_exact_dedup, op10_language_id, op11_token_alignment, op12_token_files, op13_spelling_variants,
    )
    return {f.__name__: f for f in found}


def llm_oracles() -> dict[str, str]:
    return {
        "op3_chat_format": chat.SQL, "op6_source_mix": source_mix.SQL, "op7_line_dedup": line_dedup.SQL,
        "op9_exact_dedup": exact_dedup.SQL, "op13_spelling_variants": spelling.SQL,
    }

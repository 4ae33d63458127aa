"""Queries of this subpackage, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op10_byte_bpe
from .chat_format import ORACLE as CHAT_ORACLE
from .chat_format import op4_chat_format
from .decontaminate import op8_benchmark_decontamination
from .jaccard_join import op3_jaccard_join
from .language_id import op7_language_id
from .pii import op5_pii
from .prefix_trie import ORACLE as TRIE_ORACLE
from .prefix_trie import op12_prefix_trie
from .quality_model import op2_quality_model
from .quality_rules import op9_quality_rules
from .spelling import ORACLE as SPELLING_ORACLE
from .spelling import op13_spelling_variants
from .substring_dedup import op1_substring_dedup
from .suffix_dedup import op6_suffix_dedup
from .token_files import op11_token_files


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_substring_dedup, op2_quality_model, op3_jaccard_join, op4_chat_format, op5_pii, op6_suffix_dedup, op7_language_id, op8_benchmark_decontamination, op9_quality_rules, op10_byte_bpe, op11_token_files, op12_prefix_trie, op13_spelling_variants]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_format": CHAT_ORACLE, "op12_prefix_trie": TRIE_ORACLE, "op13_spelling_variants": SPELLING_ORACLE}

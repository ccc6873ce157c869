"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chats, counts, fingerprints, neardup, packing, phrases, pieces, quality, simhash, substrings, topk, tries, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": pieces.op1_sentencepiece,
        "op2_chat_quotations": chats.op2_chat_quotations,
        "op3_token_counts": counts.op3_token_counts,
        "op4_exact_top_k": topk.op4_top_k,
        "op5_fingerprints": fingerprints.op5_fingerprints,
        "op6_best_fit_packing": packing.op6_best_fit_packing,
        "op7_near_dedup": neardup.op7_near_dedup,
        "op8_warc": warc.op8_warc,
        "op9_quality": quality.op9_quality,
        "op10_substring_dedup": substrings.op10_substring_dedup,
        "op11_simhash": simhash.op11_simhash,
        "op12_phrases": phrases.op12_phrases,
        "op13_conversation_trie": tries.op13_conversation_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_quotations": chats.SQL,
        "op4_exact_top_k": topk.SQL,
        "op7_near_dedup": neardup.SQL,
        "op8_warc": warc.SQL,
        "op10_substring_dedup": substrings.SQL,
        "op12_phrases": phrases.SQL,
        "op13_conversation_trie": tries.SQL,
    }

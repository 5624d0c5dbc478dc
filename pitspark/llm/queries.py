"""Registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitspark.llm import ann, bpe, conversations, decontaminate, jaccard, language_model, line_dedup, packing, ranked_search, secrets, suffix_dedup, token_files, toxicity

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": jaccard.op1_ngram_jaccard,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_language_model": language_model.op3_language_model,
    "op4_ann": ann.op4_ann,
    "op5_bpe": bpe.op5_bpe,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_token_files": token_files.op7_token_files,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_secrets": secrets.op10_secrets,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_packing": packing.op12_packing,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}

LLM_ORACLE: dict[str, str] = {
    "op8_line_dedup": line_dedup.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
    "op13_conversation_repair": conversations.ORACLE,
}

"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheafwork.llm import conversations, decontaminate, divergence, exact_dedup, kneser_ney, language_id, merkle, mixing, simhash, token_ids, toxicity, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": url_filter.query,
    "op2_merkle_fingerprints": merkle.query,
    "op3_language_id": language_id.query,
    "op4_kneser_ney": kneser_ney.query,
    "op5_mixing": mixing.query,
    "op6_toxicity": toxicity.query,
    "op7_token_ids": token_ids.query,
    "op8_warc_index": warc.query,
    "op9_simhash": simhash.query,
    "op10_decontamination": decontaminate.query,
    "op11_exact_dedup": exact_dedup.query,
    "op12_divergence_audit": divergence.query,
    "op13_conversation_repair": conversations.query,
}

#: The others can't be put in SQL; tests hold them against brute force, round trips or held-out accuracy.
ORACLE: dict[str, str] = {
    "op1_url_filter": url_filter.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
    "op11_exact_dedup": exact_dedup.ORACLE,
    "op12_divergence_audit": divergence.ORACLE,
    "op13_conversation_repair": conversations.ORACLE,
}

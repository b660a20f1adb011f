"""Registered queries of this folder and their SQL."""

from __future__ import annotations

from cohortloom.llm import (
    decontaminate,
    exact_dedup,
    language_id,
    phrases,
    quality,
    secrets,
    sentencepiece_sampling,
    simhash_dedup,
    token_alignment,
    token_counts,
    token_files,
    tool_calls,
    url_filter,
)

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_simhash_dedup": simhash_dedup.op5_simhash_dedup,
    "op6_token_files": token_files.op6_token_files,
    "op7_sentencepiece": sentencepiece_sampling.op7_sentencepiece,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_tool_calls": tool_calls.op9_tool_calls,
    "op10_language_id": language_id.op10_language_id,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_phrases": phrases.op12_phrases,
    "op13_quality": quality.op13_quality,
}
ORACLES = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op3_url_filter": url_filter.SQL,
    "op9_tool_calls": tool_calls.SQL,
    "op12_phrases": phrases.SQL,
}

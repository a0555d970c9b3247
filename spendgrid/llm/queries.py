"""The registered queries of this subpackage and their DuckDB restatements."""

from __future__ import annotations

from spendgrid.llm import chat_format, decontaminate, katz_model, line_dedup, near_duplicates, passage_dedup, personal_data, prefix_trie, quality_rules, secret_scan, sentencepiece_bpe, wavelet_files, whitening

_MODULES = {
    "op1_quality_rules": quality_rules,
    "op2_chat_format": chat_format,
    "op3_line_dedup": line_dedup,
    "op4_wavelet_files": wavelet_files,
    "op5_sentencepiece": sentencepiece_bpe,
    "op6_katz_model": katz_model,
    "op7_decontaminate": decontaminate,
    "op8_passage_dedup": passage_dedup,
    "op9_secret_scan": secret_scan,
    "op10_near_duplicates": near_duplicates,
    "op11_personal_data": personal_data,
    "op12_prefix_trie": prefix_trie,
    "op13_whitening": whitening,
}


def query_table() -> dict:
    return {name: getattr(module, name) for name, module in _MODULES.items()}


def oracle_table() -> dict:
    return {name: module.ORACLE_SQL for name, module in _MODULES.items() if hasattr(module, "ORACLE_SQL")}

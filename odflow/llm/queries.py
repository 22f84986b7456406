"""Registry of the training-data queries and their DuckDB SQL."""

from __future__ import annotations

from odflow.llm import bpe, conversations, importance, langid, license_scan, mil_quality, mixing, ngram_join, quality_rules, secret_scan, sharding, spotsigs, warc


def queries() -> dict:
    return {
        "op1_ngram_join": ngram_join.op1_ngram_join,
        "op2_spot_signatures": spotsigs.op2_spot_signatures,
        "op3_warc_archive": warc.op3_warc_archive,
        "op4_line_cleaning": quality_rules.op4_line_cleaning,
        "op5_mix_sources": mixing.op5_mix_sources,
        "op6_best_fit_shards": sharding.op6_best_fit_shards,
        "op7_bpe_round_trip": bpe.op7_bpe_round_trip,
        "op8_randomness_battery": secret_scan.op8_randomness_battery,
        "op9_attention_quality": mil_quality.op9_attention_quality,
        "op10_patience_licenses": license_scan.op10_patience_licenses,
        "op11_importance_resampling": importance.op11_importance_resampling,
        "op12_conversation_repair": conversations.op12_conversation_repair,
        "op13_language_filters": langid.op13_language_filters,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": ngram_join.ORACLE,
        "op4_line_cleaning": quality_rules.ORACLE,
        "op5_mix_sources": mixing.ORACLE,
        "op11_importance_resampling": importance.ORACLE,
        "op12_conversation_repair": conversations.ORACLE,
    }

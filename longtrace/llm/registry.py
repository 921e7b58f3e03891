"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from longtrace.llm import chat, codes, decontam, licenses, lines, pieces, quality, repair, rules, shards, simhash, suffixes, urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_line_dedup": lines.op2_line_dedup,
        "op3_suffix_array": suffixes.op3_suffix_array,
        "op4_sentencepiece": pieces.op4_sentencepiece,
        "op5_decontamination": decontam.op5_decontamination,
        "op6_chat_format": chat.op6_chat_format,
        "op7_sharding": shards.op7_sharding,
        "op8_url_filter": urls.op8_url_filter,
        "op9_quality_classifier": quality.op9_quality_classifier,
        "op10_quality_rules": rules.op10_quality_rules,
        "op11_license_scan": licenses.op11_license_scan,
        "op12_vector_codes": codes.op12_vector_codes,
        "op13_conversation_repair": repair.op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": lines.OP2_SQL,
        "op5_decontamination": decontam.OP5_SQL,
        "op6_chat_format": chat.OP6_SQL,
        "op10_quality_rules": rules.OP10_SQL,
        "op11_license_scan": licenses.OP11_SQL,
        "op12_vector_codes": codes.OP12_SQL,
        "op13_conversation_repair": repair.OP13_SQL,
    }

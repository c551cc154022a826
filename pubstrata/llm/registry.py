"""Queries of the corpus operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pubstrata.llm import (chat_format, exact_topk, licenses, mixing, near_dedup, packing, quality_rules, secrets, substring_dedup,
                           toxicity, turn_repair, warc, whitening)

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_mix": mixing.op2_mix,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_topk": exact_topk.op4_topk,
    "op5_pack": packing.op5_pack,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_warc": warc.op8_warc,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_licenses": licenses.op10_licenses,
    "op11_chat_format": chat_format.op11_chat_format,
    "op12_whitening": whitening.op12_whitening,
    "op13_turn_repair": turn_repair.op13_turn_repair,
}
ORACLE = {
    "op1_secret_scan": secrets.ORACLE,
    "op2_mix": mixing.ORACLE,
    "op4_topk": exact_topk.ORACLE,
    "op7_near_dedup": near_dedup.ORACLE,
    "op9_substring_dedup": substring_dedup.ORACLE,
    "op11_chat_format": chat_format.ORACLE,
    "op13_turn_repair": turn_repair.ORACLE,
}

"""Queries and DuckDB SQL of the training-data operators, by registered name."""

from __future__ import annotations

from . import (conversation_repair, decontamination, fim, line_dedup, mixing, pii, quality_classifier, quality_rules, simhash,
               substring_dedup, token_counts, token_planes, toxicity)
from .common import with_package

QUERIES = {k: with_package(q) for k, q in {
    "op1_simhash": simhash.query,
    "op2_line_dedup": line_dedup.query,
    "op3_toxicity": toxicity.query,
    "op4_quality_rules": quality_rules.query,
    "op5_token_planes": token_planes.query,
    "op6_decontamination": decontamination.query,
    "op7_personal_data": pii.query,
    "op8_source_mixing": mixing.query,
    "op9_token_counts": token_counts.query,
    "op10_quality_classifier": quality_classifier.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_fill_in_middle": fim.query,
    "op13_substring_dedup": substring_dedup.query,
}.items()}

ORACLES = {
    "op6_decontamination": decontamination.ORACLE,
    "op8_source_mixing": mixing.ORACLE,
    "op11_conversation_repair": conversation_repair.ORACLE,
    "op12_fill_in_middle": fim.ORACLE,
    "op13_substring_dedup": substring_dedup.ORACLE,
}

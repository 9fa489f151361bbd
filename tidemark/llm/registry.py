"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import (
    active_lloyd,
    language_zstd,
    lines,
    mixing,
    nn_descent,
    perspectives,
    pieces,
    ptolemaic,
    quality_rules,
    recurrent_lm,
    secrets_forest,
    simhash_anchors,
    superminhash,
)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_secrets_forest": secrets_forest.op2_secrets_forest,
    "op3_line_dedup": lines.op3_line_dedup,
    "op4_nn_descent": nn_descent.op4_nn_descent,
    "op5_recurrent_lm": recurrent_lm.op5_recurrent_lm,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_perspectives": perspectives.op7_perspectives,
    "op8_superminhash": superminhash.op8_superminhash,
    "op9_sentencepiece": pieces.op9_sentencepiece,
    "op10_language_zstd": language_zstd.op10_language_zstd,
    "op11_ptolemaic": ptolemaic.op11_ptolemaic,
    "op12_active_lloyd": active_lloyd.op12_active_lloyd,
    "op13_simhash_anchors": simhash_anchors.op13_simhash_anchors,
}

ORACLES = {
    "op3_line_dedup": lines.ORACLE,
    "op7_perspectives": perspectives.ORACLE,
    "op11_ptolemaic": ptolemaic.ORACLE,
    "op12_active_lloyd": active_lloyd.ORACLE,
}

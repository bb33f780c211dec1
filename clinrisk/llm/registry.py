"""The queries of this subpackage and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

from clinrisk.llm import (op1_line_dedup, op2_subword_lattice, op3_quality_rules, op4_quality_cnn, op5_ann_adaptive,
                          op6_packing, op7_mixing, op8_ngram_jaccard, op9_license_scan, op10_language_gru, op11_spelling_variants,
                          op12_conversation_repair, op13_token_output)

_MODULES = (op1_line_dedup, op2_subword_lattice, op3_quality_rules, op4_quality_cnn, op5_ann_adaptive,
            op6_packing, op7_mixing, op8_ngram_jaccard, op9_license_scan, op10_language_gru, op11_spelling_variants,
            op12_conversation_repair, op13_token_output)
_NAMES = [m.__name__.rsplit(".", 1)[-1] for m in _MODULES]

QUERIES = {name: getattr(m, name) for name, m in zip(_NAMES, _MODULES)}
ORACLE = {name: m.ORACLE for name, m in zip(_NAMES, _MODULES) if hasattr(m, "ORACLE")}

"""Queries of this subpackage, one for each operator, and their DuckDB statements."""

from __future__ import annotations

from . import (
    fill_middle,
    grid_join,
    hilbert,
    importance,
    licenses,
    line_crf,
    minhash,
    packing,
    pieces,
    pii,
    pseudo_lm,
    rules,
    suffix_dedup,
)

QUERIES = {
    "op1_embedding_near_dedup": grid_join.op1_embedding_near_dedup,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op3_quality_rules": rules.op3_quality_rules,
    "op4_minhash_near_dedup": minhash.op4_minhash_near_dedup,
    "op5_quality_classifier": line_crf.op5_quality_classifier,
    "op6_suffix_array_dedup": suffix_dedup.op6_suffix_array_dedup,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_pii": pii.op8_pii,
    "op9_lm_scoring": pseudo_lm.op9_lm_scoring,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_importance_resampling": importance.op11_importance_resampling,
    "op12_hilbert_sharding": hilbert.op12_hilbert_sharding,
    "op13_fill_in_middle": fill_middle.op13_fill_in_middle,
}

ORACLES: dict[str, str] = {"op1_embedding_near_dedup": grid_join.ORACLE,
                           "op3_quality_rules": rules.ORACLE,
                           "op11_importance_resampling": importance.ORACLE,
                           "op12_hilbert_sharding": hilbert.ORACLE,
                           "op13_fill_in_middle": fill_middle.ORACLE}

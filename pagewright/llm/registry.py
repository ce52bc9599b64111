"""Queries of this subpackage and, where SQL can say the whole result, their oracles."""
from __future__ import annotations

from pagewright.llm import (codes, decontaminate, jaccard, language, mixing, neardup, packing, pii, quality, resample,
                            scoring, sharding, tokens)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_language_id": language.op2_language_id,
    "op3_sharding": sharding.op3_sharding,
    "op4_packing": packing.op4_packing,
    "op5_lm_scoring": scoring.op5_lm_scoring,
    "op6_pii": pii.op6_pii,
    "op7_token_counts": tokens.op7_token_counts,
    "op8_ngram_jaccard": jaccard.op8_ngram_jaccard,
    "op9_quality": quality.op9_quality,
    "op10_near_duplicates": neardup.op10_near_duplicates,
    "op11_importance_resampling": resample.op11_importance_resampling,
    "op12_vector_codes": codes.op12_vector_codes,
    "op13_decontamination": decontaminate.op13_decontamination,
    "language_id_pages": language.language_id_pages,
}

ORACLES = {
    "op1_mixing": mixing.ORACLE,
    "op11_importance_resampling": resample.ORACLE,
    "op12_vector_codes": codes.ORACLE,
    "op13_decontamination": decontaminate.ORACLE,
}

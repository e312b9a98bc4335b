"""Queries of the training-data operators, and the DuckDB SQL where one can
express them."""

from __future__ import annotations

import corpus_pipeline
from caseflow.llm.divergence import ORACLE as DIVERGENCE_SQL
from caseflow.llm.divergence import op13_source_divergence
from caseflow.llm.exact_dedup import ORACLE as EXACT_DEDUP_SQL
from caseflow.llm.exact_dedup import op7_exact_dedup
from caseflow.llm.fingerprint import op3_fingerprints
from caseflow.llm.hard_negatives import ORACLE as HARD_NEGATIVES_SQL
from caseflow.llm.hard_negatives import op12_hard_negatives
from caseflow.llm.line_templates import op8_line_templates
from caseflow.llm.mixing import op5_mix_sources
from caseflow.llm.near_dedup import op4_near_dedup
from caseflow.llm.packing import op11_packing
from caseflow.llm.pieces import op1_sentencepiece
from caseflow.llm.quality import op6_quality
from caseflow.llm.suffix_dedup import op9_suffix_dedup
from caseflow.llm.token_files import op2_token_files
from caseflow.llm.toxicity import op10_toxicity

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_token_files": op2_token_files,
    "op3_fingerprints": op3_fingerprints,
    "op4_near_dedup": op4_near_dedup,
    "op5_mix_sources": op5_mix_sources,
    "op6_quality": op6_quality,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_line_templates": op8_line_templates,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_packing": op11_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL = {
    "op7_exact_dedup": EXACT_DEDUP_SQL,
    "op12_hard_negatives": HARD_NEGATIVES_SQL,
    "op13_source_divergence": DIVERGENCE_SQL,
}

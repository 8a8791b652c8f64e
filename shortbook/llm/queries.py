"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from shortbook.llm import decontaminate, jaccard_join, mixing, quality_rules, vector_dedup
from shortbook.llm.decontaminate import op2_benchmark_decontamination
from shortbook.llm.jaccard_join import op9_ngram_jaccard_join
from shortbook.llm.language import op4_language_id
from shortbook.llm.mixing import op3_mix_sources
from shortbook.llm.quality_model import op6_quality_rules_ensemble
from shortbook.llm.quality_rules import op10_quality_rules
from shortbook.llm.secrets import op1_secret_scan
from shortbook.llm.spelling import op11_spelling_variants
from shortbook.llm.suffix_dedup import op7_suffix_dedup
from shortbook.llm.token_alignment import op13_token_alignment
from shortbook.llm.token_files import op5_token_files
from shortbook.llm.toxicity import op8_toxicity
from shortbook.llm.vector_dedup import op12_vector_dedup

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_mix_sources": op3_mix_sources,
    "op4_language_id": op4_language_id,
    "op5_token_files": op5_token_files,
    "op6_quality_rules_ensemble": op6_quality_rules_ensemble,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_vector_dedup": op12_vector_dedup,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op2_benchmark_decontamination": decontaminate.SQL,
    "op3_mix_sources": mixing.SQL,
    "op9_ngram_jaccard_join": jaccard_join.SQL,
    "op10_quality_rules": quality_rules.SQL,
    "op12_vector_dedup": vector_dedup.SQL,
}

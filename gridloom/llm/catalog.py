"""The queries of this folder and their SQL twins."""

from __future__ import annotations

from gridloom.llm.decontaminate import op7_benchmark_decontamination
from gridloom.llm.language_cnn import op5_language_id
from gridloom.llm.lexical_search import OP13_SQL, op13_ranked_search
from gridloom.llm.line_dedup import OP8_SQL, op8_line_dedup
from gridloom.llm.merkle import OP12_SQL, op12_merkle_manifest
from gridloom.llm.mixing import OP9_SQL, op9_source_mixing
from gridloom.llm.ngram_lm import op10_lm_scoring
from gridloom.llm.quality_gam import op2_quality_classifier
from gridloom.llm.quality_rules import ABLATIONS_SQL, OP6_SQL, op6_quality_rules, quality_rule_ablations
from gridloom.llm.simhash import op1_simhash
from gridloom.llm.surrogates import op4_pii_surrogates
from gridloom.llm.toxicity import op11_toxicity
from gridloom.llm.url_filters import OP3_SQL, op3_url_filters

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_url_filters": op3_url_filters,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_language_id": op5_language_id,
    "op6_quality_rules": op6_quality_rules,
    "quality_rule_ablations": quality_rule_ablations,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_line_dedup": op8_line_dedup,
    "op9_source_mixing": op9_source_mixing,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_toxicity": op11_toxicity,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ranked_search": op13_ranked_search,
}
ORACLES = {
    "op3_url_filters": OP3_SQL,
    "op6_quality_rules": OP6_SQL,
    "quality_rule_ablations": ABLATIONS_SQL,
    "op8_line_dedup": OP8_SQL,
    "op9_source_mixing": OP9_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}

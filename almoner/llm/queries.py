"""The text operators' queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from almoner.llm import decontaminate, katz, language, line_templates, mixing, near, repetition, sharding, toxicity, url_filter

QUERIES = {
    "op1_suffix_array_repetition": repetition.op1,
    "op2_bloom_cascade_urls": url_filter.op2,
    "op3_kneser_ney_language": language.op3,
    "op4_katz_backoff": katz.op4,
    "op5_byte_prefix_sharding": sharding.op5,
    "op6_benchmark_decontamination": decontaminate.op6,
    "op7_pareto_mixing": mixing.op7,
    "op8_heavy_light_jaccard": near.op8,
    "op9_nnpu_toxicity": toxicity.op9,
    "op10_line_templates": line_templates.op10,
}

ORACLES = {
    "op1_suffix_array_repetition": repetition.ORACLE,
    "op2_bloom_cascade_urls": url_filter.ORACLE,
    "op6_benchmark_decontamination": decontaminate.ORACLE,
    "op7_pareto_mixing": mixing.ORACLE,
    "op5_byte_prefix_sharding": sharding.ORACLE,
    "op8_heavy_light_jaccard": near.ORACLE,
    "op10_line_templates": line_templates.ORACLE,
}

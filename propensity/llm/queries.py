"""The registered queries of the subpackage and the SQL they must agree with."""

from __future__ import annotations

from propensity.llm import decontaminate, lexical, near_duplicates, neighbours, packing, pii, quality, resampling, secrets, sharding, substrings, toxicity, urls

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_surrogates": pii.op2_surrogates,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_packing": packing.op4_packing,
    "op5_urls": urls.op5_urls,
    "op6_neighbours": neighbours.op6_neighbours,
    "op7_sharding": sharding.op7_sharding,
    "op8_near_duplicates": near_duplicates.op8_near_duplicates,
    "op9_secrets": secrets.op9_secrets,
    "op10_quality": quality.op10_quality,
    "op11_lexical_search": lexical.op11_lexical_search,
    "op12_resampling": resampling.op12_resampling,
    "op13_substrings": substrings.op13_substrings,
}
ORACLES = {
    "op1_decontamination": decontaminate.OP1_SQL,
    "op7_sharding": sharding.OP7_SQL,
    "op11_lexical_search": lexical.OP11_SQL,
    "op12_resampling": resampling.OP12_SQL,
    "op13_substrings": substrings.OP13_SQL,
}

"""Registry of the training-data queries and their DuckDB oracles."""

from __future__ import annotations

from landframe.llm import chat_format, decontaminate, license_scan, merkle, near_duplicates, periodic_runs, pii, quality_rules, sharding, toxicity
from landframe.llm.packing import op4_packing
from landframe.llm.secret_scan import op6_secret_scan
from landframe.llm.token_counts import op9_token_counts

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_pii_surrogates": pii.op2_pii_surrogates,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_packing": op4_packing,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_secret_scan": op6_secret_scan,
    "op7_jaccard_join": near_duplicates.op7_jaccard_join,
    "op8_sharding": sharding.op8_sharding,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_chat_format": chat_format.op11_chat_format,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

#: the others have no SQL form (tokenizers, keyed surrogates, trained models); tests/llm holds
#: them against brute force, exact round trips and held-out accuracy
ORACLE: dict[str, str] = {
    "op1_license_scan": license_scan.oracle(),
    "op3_quality_rules": quality_rules.ORACLE,
    "op5_decontamination": decontaminate.ORACLE,
    "op7_jaccard_join": near_duplicates.ORACLE,
    "op8_sharding": sharding.ORACLE,
    "op11_chat_format": chat_format.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}

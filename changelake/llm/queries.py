"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from changelake.llm import (
    bpe,
    decontaminate,
    hard_negatives,
    language_id,
    license_scan,
    minhash_dedup,
    personal_data,
    quality_rules,
    ranked_search,
    sharding,
    substring_dedup,
    suffix_dedup,
    toxicity,
)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_toxicity": toxicity.query,
    "op3_personal_data": personal_data.query,
    "op4_suffix_dedup": suffix_dedup.query,
    "op5_bpe": bpe.query,
    "op6_decontaminate": decontaminate.query,
    "op7_license_scan": license_scan.query,
    "op8_language_id": language_id.query,
    "op9_substring_dedup": substring_dedup.query,
    "op10_minhash_dedup": minhash_dedup.query,
    "op11_sharding": sharding.query,
    "op12_ranked_search": ranked_search.query,
    "op13_hard_negatives": hard_negatives.query,
}

#: DuckDB SQL for the queries that SQL can express; the others are tested by brute force.
ORACLES: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE_SQL,
    "op6_decontaminate": decontaminate.ORACLE_SQL,
    "op12_ranked_search": ranked_search.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}

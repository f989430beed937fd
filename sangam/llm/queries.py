"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from . import (
    bpe,
    chaining,
    decontamination,
    fill_in_middle,
    jaccard_join,
    minhash,
    oracle,
    prefix_trie,
    quality_rules,
    rule_ensemble,
    secrets,
    sharding,
    suffix_dedup,
    warc,
)

QUERIES = {
    "op1_suffix_array": suffix_dedup.op1_suffix_array,
    "op2_rule_ensemble": rule_ensemble.op2_rule_ensemble,
    "op3_bpe": bpe.op3_bpe,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_secrets": secrets.op5_secrets,
    "op6_chaining": chaining.op6_chaining,
    "op7_minhash": minhash.op7_minhash,
    "op8_sharding": sharding.op8_sharding,
    "op9_warc": warc.op9_warc,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_jaccard_join": jaccard_join.op13_jaccard_join,
}


def sql() -> dict[str, str]:
    return dict(oracle.SQL)

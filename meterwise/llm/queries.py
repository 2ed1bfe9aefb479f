"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from meterwise.llm import (
    chat,
    fim,
    hard_negatives,
    jaccard_join,
    line_rules,
    mixing,
    packing,
    secrets,
    sharding,
    simhash,
    token_files,
    topk_search,
    toxicity,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_quality_rules": line_rules.op2_quality_rules,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_token_files": token_files.op4_token_files,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_sharding": sharding.op6_sharding,
    "op7_chat_format": chat.op7_chat_format,
    "op8_topk_search": topk_search.op8_topk_search,
    "op9_packing": packing.op9_packing,
    "op10_mixing": mixing.op10_mixing,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_simhash": simhash.op12_simhash,
    "op13_fill_in_middle": fim.op13_fill_in_middle,
}

ORACLE = {
    "op2_quality_rules": line_rules.ORACLE,
    "op7_chat_format": chat.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op13_fill_in_middle": fim.ORACLE,
}

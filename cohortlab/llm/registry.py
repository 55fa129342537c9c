"""Queries of the training-data operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from cohortlab.llm import (
    ann, bpe, chat, chat_repair, html_extract, line_dedup, lm, minhash, mixing, quality, runs, sharding, sigtree,
)

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_html_extraction": html_extract.op2_html_extraction,
    "op3_lm_scoring": lm.op3_lm_scoring,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_sharding": sharding.op5_sharding,
    "op6_mixing": mixing.op6_mixing,
    "op7_quality_rules": quality.op7_quality_rules,
    "op8_chat_formatting": chat.op8_chat_formatting,
    "op9_minhash": minhash.op9_minhash,
    "op10_multi_index": ann.op10_multi_index,
    "op11_chat_repair": chat_repair.op11_chat_repair,
    "op12_periodic_runs": runs.op12_periodic_runs,
    "op13_signature_trees": sigtree.op13_signature_trees,
}

ORACLE = {
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op6_mixing": mixing.OP6_SQL,
    "op8_chat_formatting": chat.OP8_SQL,
    "op11_chat_repair": chat_repair.OP11_SQL,
}

"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from tillroll.llm import adaptive_quality, anchor_lists, chat_grammar, duckdb_bpe, html_wrappers, kmeans_tree, line_edit_join, minhash_forest, packing, phrase_automata, suffix_dedup, temperature_mix, warc_transactions

QUERIES = {
    "op1_minhash_forest": minhash_forest.query,
    "op2_warc_transactions": warc_transactions.query,
    "op3_html_wrappers": html_wrappers.query,
    "op4_temperature_mix": temperature_mix.query,
    "op5_chat_grammar": chat_grammar.query,
    "op6_concat_and_cut": packing.query,
    "op7_kmeans_tree": kmeans_tree.query,
    "op8_adaptive_quality": adaptive_quality.query,
    "op9_suffix_dedup": suffix_dedup.query,
    "op10_line_edit_join": line_edit_join.query,
    "op11_phrase_automata": phrase_automata.query,
    "op12_duckdb_bpe": duckdb_bpe.query,
    "op13_anchor_lists": anchor_lists.query,
}

ORACLE = {
    "op2_warc_transactions": warc_transactions.SQL,
    "op5_chat_grammar": chat_grammar.SQL,
    "op8_adaptive_quality": adaptive_quality.SQL,
    "op11_phrase_automata": phrase_automata.SQL,
    "op13_anchor_lists": anchor_lists.SQL,
}

"""The queries of this package and their check SQL."""

from finfacts.llm import (
    chat_format, embedding_dedup, grade_classifier, line_dedup, packing, periodic_runs, prefix_trie,
    quality_rules, sentence_pieces, simhash_dedup, token_store, url_filter, window_packing,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_sentence_pieces": sentence_pieces.op3_sentence_pieces,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_simhash_dedup": simhash_dedup.op5_simhash_dedup,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_token_store": token_store.op7_token_store,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_quality_classifier": grade_classifier.op9_quality_classifier,
    "op10_chat_format": chat_format.op10_chat_format,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_window_packing": window_packing.op13_window_packing,
}

ORACLES = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op2_url_filter": url_filter.OP2_SQL,
    "op10_chat_format": chat_format.OP10_SQL,
}

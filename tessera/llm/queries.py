"""Queries of the training-data operators, for ``__spark_entry__.py``."""

from __future__ import annotations

from . import (alignment, chat, decontaminate, exact_dedup, hidden_markov, near_dedup, ranked_search, sentence_pieces,
               sharding, substring_dedup, token_counts, toxicity, warc)

QUERIES = {
    "op1_token_counts": token_counts.q_token_counts,
    "op2_sentence_pieces": sentence_pieces.q_sentence_pieces,
    "op3_sharding": sharding.q_sharding,
    "op4_exact_dedup": exact_dedup.q_exact_dedup,
    "op5_hidden_markov": hidden_markov.q_hidden_markov,
    "op6_substring_dedup": substring_dedup.q_substring_dedup,
    "op7_decontaminate": decontaminate.q_decontaminate,
    "op8_near_dedup": near_dedup.q_near_dedup,
    "op9_warc": warc.q_warc,
    "op10_toxicity": toxicity.q_toxicity,
    "op11_alignment": alignment.q_alignment,
    "op12_chat": chat.q_chat,
    "op13_ranked_search": ranked_search.q_ranked_search,
}

# DuckDB twins, where SQL can express the result
ORACLE: dict[str, str] = {
    "op4_exact_dedup": exact_dedup.SQL_EXACT_DEDUP,
    "op9_warc": warc.SQL_WARC,
    "op12_chat": chat.SQL_CHAT,
    "op13_ranked_search": ranked_search.SQL_RANKED_SEARCH,
}

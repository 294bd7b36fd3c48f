"""Queries of this subpackage and their DuckDB SQL, by registered name."""
from __future__ import annotations

from touchline.llm.bpe import op9_byte_bpe
from touchline.llm.chat import OP4_SQL, op4_chat_formatting
from touchline.llm.extraction import op8_html_extraction
from touchline.llm.jaccard import op10_ngram_jaccard
from touchline.llm.language_id import op13_language_id
from touchline.llm.ppm import op6_ppm_scores
from touchline.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from touchline.llm.resampling import OP11_SQL, op11_importance_resampling
from touchline.llm.secrets import op3_secret_scan
from touchline.llm.sharding import op5_sharding
from touchline.llm.tiling import op1_decontamination
from touchline.llm.topk import OP7_SQL, op7_top_k
from touchline.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_secret_scan": op3_secret_scan,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_sharding": op5_sharding,
    "op6_ppm_scores": op6_ppm_scores,
    "op7_threshold_top_k": op7_top_k,
    "op8_html_extraction": op8_html_extraction,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_language_id": op13_language_id,
}

ORACLE_SQL = {
    "op4_chat_formatting": OP4_SQL,
    "op7_threshold_top_k": OP7_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
}

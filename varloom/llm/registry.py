"""Queries of this subpackage and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

from varloom.llm.byte_bpe import op9_byte_bpe
from varloom.llm.decontaminate import OP8_SQL, op8_decontaminate
from varloom.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from varloom.llm.html_text import op5_html_text
from varloom.llm.jaccard_join import OP10_SQL, op10_jaccard_join
from varloom.llm.language_id import op4_language_id
from varloom.llm.lexical_search import OP11_SQL, op11_lexical_search
from varloom.llm.lm_scoring import op7_lm_scoring
from varloom.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from varloom.llm.source_mix import OP12_SQL, op12_source_mix
from varloom.llm.substring_dedup import OP2_SQL, op2_substring_dedup
from varloom.llm.token_shards import op3_token_shards
from varloom.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_shards": op3_token_shards,
    "op4_language_id": op4_language_id,
    "op5_html_text": op5_html_text,
    "op6_toxicity": op6_toxicity,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_decontaminate": op8_decontaminate,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_lexical_search": op11_lexical_search,
    "op12_source_mix": op12_source_mix,
    "op13_prefix_trie": op13_prefix_trie,
}
SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op2_substring_dedup": OP2_SQL,
    "op8_decontaminate": OP8_SQL,
    "op10_jaccard_join": OP10_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_source_mix": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}

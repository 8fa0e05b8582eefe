"""The queries of this subpackage and their SQL, for the repository's entry module."""

from __future__ import annotations

from changeloom.llm.audio import op9_telephony
from changeloom.llm.audit import OP11_SQL, op11_filter_audit
from changeloom.llm.bpe import op1_byte_bpe
from changeloom.llm.crosspolytope import op13_cross_polytope
from changeloom.llm.html import op2_tag_path_text
from changeloom.llm.langid import op10_zstd_language
from changeloom.llm.minhash import op6_minmax_dedup
from changeloom.llm.mixing import OP3_SQL, op3_pareto_mix
from changeloom.llm.sharding import op4_interleaved_shards
from changeloom.llm.spotsigs import op7_spotsigs, spotsigs_near_duplicates
from changeloom.llm.toolcalls import OP5_SQL, op5_tool_calls
from changeloom.llm.toxicity import op8_toxic_segments
from changeloom.llm.trie import OP12_SQL, op12_prefix_trie

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_tag_path_text": op2_tag_path_text,
    "op3_pareto_mix": op3_pareto_mix,
    "op4_interleaved_shards": op4_interleaved_shards,
    "op5_tool_calls": op5_tool_calls,
    "op6_minmax_dedup": op6_minmax_dedup,
    "op7_spotsigs": op7_spotsigs,
    "spotsigs_near_duplicates": spotsigs_near_duplicates,
    "op8_toxic_segments": op8_toxic_segments,
    "op9_telephony": op9_telephony,
    "op10_zstd_language": op10_zstd_language,
    "op11_filter_audit": op11_filter_audit,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_cross_polytope": op13_cross_polytope,
}
ORACLE_SQL = {"op3_pareto_mix": OP3_SQL, "op5_tool_calls": OP5_SQL, "op11_filter_audit": OP11_SQL, "op12_prefix_trie": OP12_SQL}

"""Registered queries of the training-data operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from footfall.llm.chunk_dedup import ORACLE_OP2, op2_chunk_dedup
from footfall.llm.gray_simhash import op10_gray_simhash
from footfall.llm.host_consensus import op8_host_consensus
from footfall.llm.impact_index import ORACLE_OP5, op5_impact_topk
from footfall.llm.interp_lm import op3_interp_lm
from footfall.llm.lang_id import op6_lang_id
from footfall.llm.line_crf import op13_line_crf
from footfall.llm.mixing import op1_mixing
from footfall.llm.pii_lstm import op9_pii_lstm
from footfall.llm.prefix_trie import ORACLE_OP12, op12_prefix_trie
from footfall.llm.reply_trees import ORACLE_OP4, op4_reply_trees
from footfall.llm.sp_codec import op7_sp_codec
from footfall.llm.whitening import op11_whitening

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_chunk_dedup": op2_chunk_dedup,
    "op3_interp_lm": op3_interp_lm,
    "op4_reply_trees": op4_reply_trees,
    "op5_impact_topk": op5_impact_topk,
    "op6_lang_id": op6_lang_id,
    "op7_sp_codec": op7_sp_codec,
    "op8_host_consensus": op8_host_consensus,
    "op9_pii_lstm": op9_pii_lstm,
    "op10_gray_simhash": op10_gray_simhash,
    "op11_whitening": op11_whitening,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_line_crf": op13_line_crf,
}

ORACLE = {
    "op2_chunk_dedup": ORACLE_OP2,
    "op4_reply_trees": ORACLE_OP4,
    "op5_impact_topk": ORACLE_OP5,
    "op12_prefix_trie": ORACLE_OP12,
}

"""The queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

from transqa.llm.chat import OP11_SQL, op11_chat_format
from transqa.llm.embeddings import OP2_SQL, op2_embedding_near_dedup
from transqa.llm.minhash import op5_minhash_near_dedup
from transqa.llm.mixing import OP3_SQL, op3_mixing
from transqa.llm.passages import op8_substring_dedup
from transqa.llm.quality import OP6_SQL, op6_quality_rules
from transqa.llm.repair import op13_conversation_repair
from transqa.llm.search import OP12_SQL, op12_lexical_search
from transqa.llm.secrets import op7_secret_scans
from transqa.llm.sentencepiece import op1_sentencepiece
from transqa.llm.sharding import op4_sharding
from transqa.llm.token_files import op10_token_planes
from transqa.llm.warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_mixing": op3_mixing,
    "op4_sharding": op4_sharding,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_secret_scans": op7_secret_scans,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_warc": op9_warc,
    "op10_token_planes": op10_token_planes,
    "op11_chat_format": op11_chat_format,
    "op12_lexical_search": op12_lexical_search,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES = {
    "op2_embedding_near_dedup": OP2_SQL,
    "op3_mixing": OP3_SQL,
    "op6_quality_rules": OP6_SQL,
    "op9_warc": OP9_SQL,
    "op11_chat_format": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
}

"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from stationcast.llm.bpe import op5_bpe_roundtrip
from stationcast.llm.conversation_repair import op13_conversation_repair
from stationcast.llm.filter_audit import OP12_SQL, op12_filter_audit
from stationcast.llm.lang_id import op7_language_id
from stationcast.llm.line_dedup import OP3_SQL, op3_line_dedup
from stationcast.llm.lm_scoring import OP2_SQL, op2_stupid_backoff
from stationcast.llm.mixing import op6_source_mixing
from stationcast.llm.near_dups import op10_near_duplicates
from stationcast.llm.packing import op11_pack_sequences
from stationcast.llm.quality_gam import op9_quality_gam
from stationcast.llm.quality_rules import op8_quality_rules
from stationcast.llm.simhash import op4_simhash
from stationcast.llm.simple8b import op1_simple8b_tokens

REGISTERED = {
    "op1_simple8b_tokens": op1_simple8b_tokens,
    "op2_stupid_backoff": op2_stupid_backoff,
    "op3_line_dedup": op3_line_dedup,
    "op4_simhash": op4_simhash,
    "op5_bpe_roundtrip": op5_bpe_roundtrip,
    "op6_source_mixing": op6_source_mixing,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_gam": op9_quality_gam,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_pack_sequences": op11_pack_sequences,
    "op12_filter_audit": op12_filter_audit,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {
    "op2_stupid_backoff": OP2_SQL,
    "op3_line_dedup": OP3_SQL,
    "op12_filter_audit": OP12_SQL,
}

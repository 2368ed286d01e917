"""Registered queries and SQL of the operators of this subpackage."""

from __future__ import annotations

from strata.llm.chat_format import OP3_SQL, op3_chat_format
from strata.llm.conversation_trie import OP11_SQL, op11_conversation_trie
from strata.llm.decontamination import OP4_SQL, op4_benchmark_decontamination
from strata.llm.filter_audit import OP13_SQL, op13_filter_audit
from strata.llm.fingerprints import op12_fingerprints
from strata.llm.jaccard_join import op9_jaccard_join
from strata.llm.line_dedup import OP1_SQL, op1_line_dedup
from strata.llm.mixing import op8_mixing
from strata.llm.quality_classifier import op10_quality_classifier
from strata.llm.quality_rules import OP7_SQL, op7_quality_rules
from strata.llm.substring_dedup import OP5_SQL, op5_substring_dedup
from strata.llm.suffix_dedup import op6_suffix_dedup
from strata.llm.warc_audit import OP2_SQL, op2_warc_audit

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_warc_audit": op2_warc_audit,
    "op3_chat_format": op3_chat_format,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_fingerprints": op12_fingerprints,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES = {
    "op1_line_dedup": OP1_SQL,
    "op2_warc_audit": OP2_SQL,
    "op3_chat_format": OP3_SQL,
    "op4_benchmark_decontamination": OP4_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op7_quality_rules": OP7_SQL,
    "op11_conversation_trie": OP11_SQL,
    "op13_filter_audit": OP13_SQL,
}

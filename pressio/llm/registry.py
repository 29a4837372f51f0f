"""The corpus queries, by the name they are registered under."""

from __future__ import annotations

from . import queries as Q
from .oracles import ORACLES

QUERIES = {fn.__name__: fn for fn in (
    Q.op1_minhash,
    Q.op2_warc_revisit,
    Q.op3_line_dedup,
    Q.op4_quality,
    Q.op5_embedding_dedup,
    Q.op6_bpe_roundtrip,
    Q.op7_language_id,
    Q.op8_mixing,
    Q.op9_suffix_dedup,
    Q.op10_knn_join,
    Q.op11_quality_rules,
    Q.op12_turn_repair,
    Q.op13_filter_audit,
)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

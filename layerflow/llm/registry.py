"""Queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from layerflow.llm import chat, decontam, langid, licences, ngram_join, packing, pii, quality, ranked_search
from layerflow.llm import secret_scan, spelling, token_counts, warc

QUERIES = {
    "op1_decontam": decontam.op1_decontam,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_warc": warc.op3_warc,
    "op4_quality": quality.op4_quality,
    "op5_chat": chat.op5_chat,
    "op6_secrets": secret_scan.op6_secrets,
    "op7_pii": pii.op7_pii,
    "op8_packing": packing.op8_packing,
    "op9_langid": langid.op9_langid,
    "op10_licences": licences.op10_licences,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_spelling": spelling.op12_spelling,
    "op13_token_counts": token_counts.op13_token_counts,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_join": ngram_join.OP2_SQL,
        "op3_warc": warc.OP3_SQL,
        "op4_quality": quality.OP4_SQL,
        "op5_chat": chat.OP5_SQL,
        "op11_ranked_search": ranked_search.OP11_SQL,
        "op12_spelling": spelling.OP12_SQL,
    }

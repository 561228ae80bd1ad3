"""The operators as queries over whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, decontam, fim, hmm, html, jaccard, langid, merkle, paragraphs, syncmers, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_hmm": hmm.op1_hmm,
        "op2_warc": warc.op2_warc,
        "op3_jaccard": jaccard.op3_jaccard,
        "op4_langid": langid.op4_langid,
        "op5_paragraphs": paragraphs.op5_paragraphs,
        "op6_html": html.op6_html,
        "op7_decontam": decontam.op7_decontam,
        "op8_chat": chat.op8_chat,
        "op9_bpe": bpe.op9_bpe,
        "op10_syncmers": syncmers.op10_syncmers,
        "op11_fim": fim.op11_fim,
        "op12_merkle": merkle.op12_merkle,
        "op13_toxicity": toxicity.op13_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": warc.OP2_SQL, "op3_jaccard": jaccard.OP3_SQL, "op7_decontam": decontam.OP7_SQL, "op8_chat": chat.OP8_SQL, "op11_fim": fim.OP11_SQL, "op12_merkle": merkle.OP12_SQL}

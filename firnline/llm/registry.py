"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from firnline.llm import chat, langid, media, minhash, mixing, quality, secrets, spm, topk, toxicity

QUERIES = {
    "op1_minhash": minhash.op1_minhash,
    "op2_topk": topk.op2_topk,
    "op3_langid": langid.op3_langid,
    "op4_quality": quality.op4_quality,
    "op5_sentencepiece": spm.op5_sentencepiece,
    "op6_chat": chat.op6_chat,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_media": media.op8_media,
    "op9_secrets": secrets.op9_secrets,
    "op10_mixing": mixing.op10_mixing,
}

SQL: dict[str, str] = {
    "op1_minhash": minhash.SQL,
    "op2_topk": topk.SQL,
    "op6_chat": chat.SQL,
}

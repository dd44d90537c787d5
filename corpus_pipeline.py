"""Corpus pipeline: toxicity, near-duplicates, secrets, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents; the last returns each kept document's tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firnline.llm import minhash, mixing, secrets, spm, toxicity
from firnline.llm.common import load, materialize

STAGES = [
    ("toxicity", toxicity.stage),  # documents with a score of 0.5 or more go
    ("minhash_dedup", minhash.stage),  # one document of each class of near copies stays
    ("secrets", secrets.stage),  # secrets are replaced in the texts
    ("mixing", mixing.stage),  # documents repeat or go, by their source's target
    ("sentencepiece", spm.stage),  # texts become token ids
]

#: Trained scores, signatures and Viterbi paths are not expressible in SQL; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

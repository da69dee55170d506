"""Training-data pipeline: language ID, toxicity, near-duplicates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import jaccard, language, packing, toxicity
from tidemark.llm.common import checkpoint, table

STAGES = [
    ("language_id", language.stage),
    ("toxicity", toxicity.stage),
    ("ngram_jaccard", jaccard.stage),
    ("packing", packing.stage),
]

#: No SQL expresses the learned stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each on all that the one before it kept, written and read again in between."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = checkpoint(docs)
    return docs

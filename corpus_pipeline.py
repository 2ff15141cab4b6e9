"""Training-data pipeline: quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All stages but the last return the columns of documents; the last one
returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logtally.llm import chunks, minhash, packing, quality
from logtally.llm.queries import table, vocabulary
from logtally.llm.shared import written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more."""
    return quality.accepted(spark, docs, table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.deduplicate(spark, docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stay in one document only."""
    return chunks.remove_repeats(spark, docs, counts=False)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 4096 tokens."""
    return packing.pack_documents(spark, docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

# A model's scores decide what the first stage keeps, so no SQL gives run()'s
# rows; tests/llm compares every stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

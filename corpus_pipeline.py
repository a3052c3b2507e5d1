"""From raw documents to packed sequences, stage by stage.

Every stage takes all rows that the one before it kept and returns the columns of ``documents``, but for
the last, which returns the pieces of packed sequences. Stages meet as stored tables.

Null and empty texts pass all stages: they are not toxic, are copies of each other, hold no personal data, have size 0 in
the mix and are packed as an end id alone. Null doc_ids stay null; repeated rows are judged alike, and of near duplicates one
row stays. Texts of any length are read whole, and without documents there are no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm.near_dedup import one_per_group
from ledgermill.llm.packing import pack_documents
from ledgermill.llm.pii import redact
from ledgermill.llm.queries import WORD_BPE
from ledgermill.llm.source_mixing import mix
from ledgermill.llm.toxicity import without_toxic
from ledgermill.session import stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays.

    Groups are those of SimHash fingerprints over shingles of three words that differ in at most two bits.
    """
    return one_per_group(docs, shingle_words=3, radius=2)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their target weights; a document may come twice or not at all."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 tokens."""
    return pack_documents(docs, WORD_BPE, capacity=2048, end_id=1, forget=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mixing", mixing),
    ("packing", packing),
]
# Tokenizers and the learnt stages are beyond SQL; tests/llm/test_pipeline.py compares with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Token counts through a cache of digests.

A text's normalised content (null as the empty text; nothing else is changed, since the counts are
those of the text as it is) and the tokenizer's file are digested. Digests that the cache holds are
joined to their counts; of the others each is encoded once, whatever number of documents has it, and
appended to the cache. The cache is a Parquet folder that any number of runs may share.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.texts import text_of
from ledgermill.llm.tokenizing import encoder, shared_tokenizer
from ledgermill.operators.joins import attach
from ledgermill.session import scratch_path

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens bigint"
COUNT_LIMIT = 1024


def _stored_counts(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """Counts in the cache for this tokenizer, one row per digest."""
    # An empty first part, so that a cache that nobody has written to yet reads as an empty one.
    spark.createDataFrame([], CACHE_SCHEMA).coalesce(1).write.mode("append").parquet(cache_path)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    return (
        stored.filter(F.col("tokenizer_digest") == version)
        .groupBy("content_digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, limit: int = COUNT_LIMIT
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n_bytes, n_tokens, over_limit.

    ``cache_path`` is created where it does not exist; without one the run starts a new cache in the
    shared folder. Two runs that append the same digest at once do no harm: counts are equal.

    Null and empty texts count 0 tokens. A null doc_id stays null; repeated rows give repeated rows;
    texts of any length are counted whole; an empty table gives no rows. Other columns of ``docs`` are not looked at, whatever their names.
    """
    spark = docs.sparkSession
    content, version = shared_tokenizer(spark, tokenizer_path)
    cache_path = cache_path or scratch_path(spark, "token-count-cache")
    rows = docs.select("doc_id", text_of().alias("text")).withColumn(
        "content_digest", F.unhex(F.sha2("text", 256))
    )
    # Copies meet before the shuffle, so a text that a third of all documents share moves once per task.
    distinct = rows.select("content_digest", "text").dropDuplicates(["content_digest"])
    misses = distinct.join(_stored_counts(spark, cache_path, version), "content_digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(content.value, version)
        for batch in batches:
            counts = list(known.counts(batch.column("text").to_pylist()))
            columns = [batch.column("content_digest"), pa.array([version] * len(counts)), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["content_digest", "tokenizer_digest", "n_tokens"])

    misses.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    keys = rows.select("doc_id", "content_digest", F.octet_length("text").cast("bigint").alias("n_bytes"))
    counted = attach(
        keys,
        _stored_counts(spark, cache_path, version),
        {"content_digest": "content_digest"},
        "inner",
    )
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

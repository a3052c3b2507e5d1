"""Snapshots of a table in buckets by key, with a digest of every bucket, so that equal buckets are never read again.

A digest is the number of rows and two sums of their hashes, which need no order. Two snapshots of one table are
compared by their digests, a few rows; only buckets whose digests differ are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.operators.changes import snapshot_diff

DEFAULT_BUCKETS = 256
_DIGEST = ("n_rows", "mark", "other_mark")


def _mark(columns: Sequence[str], seed: int) -> Column:
    """Sum of hashes of rows. A hash passes nulls over, so where they are is hashed too."""
    parts = [part for name in columns for part in (F.col(name), F.isnull(name))]
    return F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)"))


def write_snapshot(frame: DataFrame, path: str, keys: Sequence[str], buckets: int = DEFAULT_BUCKETS) -> None:
    """Store a table under a new path, in ``buckets`` by ``keys``; snapshots to be compared need the same number.

    Rows with NULL keys lie in buckets like any other; equal rows count as often as they occur.
    """
    spark, columns = frame.sparkSession, frame.columns
    placed = frame.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    # Rows of a bucket come together in few files; a very large bucket is split between tasks.
    placed.hint("rebalance", "bucket").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/rows")
    written = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    marks = [F.count("*"), _mark(columns, 1), _mark(columns, 2)]
    digests = written.groupBy("bucket").agg(*(m.alias(name) for m, name in zip(marks, _DIGEST, strict=True)))
    frame.limit(0).coalesce(1).write.parquet(f"{path}/schema")
    digests.coalesce(1).write.parquet(f"{path}/digests")


def differing_buckets(spark: SparkSession, old: str, new: str) -> DataFrame:
    """Buckets of two snapshots whose digests differ, or that only one of them has: at most as many rows as buckets."""
    sides = [spark.read.parquet(f"{path}/digests") for path in (old, new)]
    digests = sides[0].withColumn("_side", F.lit(-1)).unionByName(sides[1].withColumn("_side", F.lit(1)))
    apart = digests.groupBy("bucket", *_DIGEST).agg(F.sum("_side").alias("_net")).filter("_net <> 0")
    return apart.select("bucket").distinct()


def diff_snapshots(spark: SparkSession, old: str, new: str, keys: Sequence[str]) -> DataFrame:
    """The change feed from one stored snapshot to another, as ``snapshot_diff`` gives it for the whole tables.

    Of both only the buckets that differ are read.
    """
    buckets = F.broadcast(differing_buckets(spark, old, new))
    # The schema is kept beside the rows, so that none of their files has to be opened for it.
    schema = spark.read.parquet(f"{old}/schema").schema
    reader = spark.read.schema(T.StructType([*schema, T.StructField("bucket", T.IntegerType())]))
    before, after = (reader.parquet(f"{path}/rows").join(buckets, "bucket", "left_semi").drop("bucket") for path in (old, new))
    return snapshot_diff(before, after, keys)

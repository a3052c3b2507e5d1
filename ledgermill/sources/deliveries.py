"""The ledger of loaded files: what a load reads is decided by what files hold, not by their age or name alone.

A file is looked at if the ledger lacks its path with its size and age; whether it is late, by its time stamp, plays
no part. Of what is looked at the content decides: a file whose content was loaded before, renamed, copied or only
touched, is entered and not loaded again, and one that was replaced under its name is loaded. Contents are compared by
the number of lines and two sums of their hashes, which need no order and so come from split files too.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.joins import attach

LEDGER_SCHEMA = "path string, size bigint, modified timestamp, digest string, batch_id bigint"
_SEEN = ("path", "size", "modified")
# Signs that a reader would take for a pattern of names.
_PATTERN = re.compile(r"([\\{}\[\]*?])")


def delivered_files(spark: SparkSession, path: str | Sequence[str], pattern: str = "*.{csv,csv.gz}") -> DataFrame:
    """Path, size and age of the files under a path, packed or not; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("_name"))


def as_path(path: str) -> str:
    """A file's path as a reader takes it literally."""
    return _PATTERN.sub(r"\\\1", path)


def with_digests(files: DataFrame) -> DataFrame:
    """``files`` with ``digest``, which stands for their content; each is read once, split between tasks.

    Only paths reach the driver.
    """
    paths = [as_path(row.path) for row in files.select("path").distinct().collect()]
    if not paths:
        return files.withColumn("digest", F.lit("").cast("string")).drop("_name")
    lines = files.sparkSession.read.text(paths).select(F.col("_metadata.file_path").alias("_file"), "value")
    # The sums are of numbers below 2^62, as decimals, so that they can't overflow.
    marks = [F.sum((F.xxhash64(F.lit(seed), "value").bitwiseAND((1 << 62) - 1)).cast("decimal(38,0)")) for seed in (1, 2)]
    contents = lines.groupBy("_file").agg(F.concat_ws(":", F.count("*"), *(m.cast("string") for m in marks)).alias("digest"))
    return attach(files, contents, {"_name": "_file"}).withColumn("digest", F.coalesce("digest", F.lit("0"))).drop("_name")


def new_files(files: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """Files that the ledger lacks as they are, by path, size and age; all of them if forced."""
    if force:
        return files
    return attach(files, ledger.select(*_SEEN).distinct(), {name: name for name in _SEEN}, "left_anti")


def to_load(found: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """Of new files with digests those to load: one for each content that was never loaded; all of them if forced."""
    if force:
        return found
    fresh = attach(found, ledger.select("digest").distinct(), {"digest": "digest"}, "left_anti")
    return fresh.groupBy("digest").agg(F.min("path").alias("path")).select("path", "digest")


def record_files(ledger: DataFrame, files: DataFrame, batch_id: int) -> DataFrame:
    """Ledger with the files of a load added; files without a digest are known by path, size and age only."""
    entries = files if "digest" in files.columns else files.withColumn("digest", F.lit(None).cast("string"))
    return ledger.unionByName(entries.select(*_SEEN, "digest", F.lit(batch_id).cast("bigint").alias("batch_id")))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)

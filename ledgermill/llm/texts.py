"""What the operators on documents share: reading, words and the cut of a table into tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, as a class of a regular expression.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """A text, null as the empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def n_words_of(column: str = "text") -> Column:
    """Number of words: the places where a word begins, without making the words."""
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("bigint")


def words_of(text: str | None) -> list[bytes]:
    """The words as UTF-8. ``bytes.split`` separates at exactly the white space of ``WORD``."""
    return text.encode().split() if text else []

"""Which rows may have a partner among many keys, told without shuffling the rows.

Hashes of the keys are bits of words, which are broadcast: about a byte per key. A row whose bit is not set surely has no
partner and needs no join; one whose bit is set may have one, which the join that follows finds out. So where few rows of a
large table are meant, only these and one in nine of the others are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# From so many keys on it pays to mark them; fewer are broadcast or shuffled as they are.
MANY_KEYS = 200_000
# Bits marked per key, and the most bits there are (64 MB), above which more rows are joined in vain.
BITS_PER_KEY, MOST_BITS = 8, 1 << 29
# Words of 64 bits that are kept in one row.
WORDS = 64
_ROW = WORDS * 64


class Marks:
    """Marks of keys (``on``), which ``split`` tells rows apart by. Without a ``table`` every row may have a partner."""

    def __init__(self, table: DataFrame | None, n_bits: int = _ROW):
        self.table = table
        self.n_bits = n_bits

    def split(self, rows: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
        """Rows that may have a partner, and rows that have none, ``None`` if nothing is known of that."""
        if self.table is None:
            return rows, None
        at = F.pmod(F.xxhash64(*on), F.lit(self.n_bits))
        placed = rows.withColumn("_at", at).withColumn("_row", F.expr(f"_at div {_ROW}"))
        joined = placed.join(F.broadcast(self.table), "_row", "left")
        word = F.expr(f"get(_words, cast(_at div 64 % {WORDS} as int))")
        bit = F.expr("cast(_at % 64 as int)")
        marked = F.coalesce(F.call_function("shiftrightunsigned", word, bit).bitwiseAND(F.lit(1)) != 0, F.lit(False))
        found = joined.withColumn("_marked", marked)
        return tuple(found.filter(test).select(*rows.columns) for test in (F.col("_marked"), ~F.col("_marked")))

    def likely(self, rows: DataFrame, on: Sequence[str]) -> DataFrame:
        """Rows that may have a partner."""
        return self.split(rows, on)[0]


def marks(keys: DataFrame, on: Sequence[str], n_keys: int | None = None, most_bits: int | None = None, many: int | None = None) -> Marks:
    """Marks of the keys in a stored table, at most ``n_keys``, none if they are few."""
    n_keys = keys.count() if n_keys is None else n_keys
    if n_keys < (MANY_KEYS if many is None else many):
        return Marks(None)
    n_bits = min(max(1, -(-n_keys * BITS_PER_KEY // _ROW)) * _ROW, most_bits or MOST_BITS)
    places = keys.select(F.pmod(F.xxhash64(*on), F.lit(n_bits)).alias("_at"))
    bit: Column = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.expr("cast(_at % 64 as int)"))
    words = places.groupBy(F.expr(f"_at div {_ROW}").alias("_row"), F.expr(f"cast(_at div 64 % {WORDS} as int)").alias("_place")).agg(
        F.bit_or(bit).alias("_word")
    )
    listed = words.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_place", "_word"))).alias("_words"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda n: F.coalesce(F.col("_words")[n], F.lit(0).cast("bigint")))
    return Marks(listed.select("_row", dense.alias("_words")), n_bits)

"""Connected components of a graph given as links, by alternating stars.

Every round hangs each node's larger neighbours, then its smaller ones, on the smallest node it sees.
Distances shrink fast, no node's neighbours are ever gathered in one place, and each round's links are
a stored table, so the lineage stays short and an executor's loss costs one round's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.joins import attach
from ledgermill.session import stored


def _hung(pairs: DataFrame) -> DataFrame:
    """(v, smallest neighbour of u or u itself) for all pairs (u, v)."""
    smallest = pairs.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return attach(pairs, smallest, {"u": "u"}, "inner")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _hung(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hung = _hung(down)
    moved = hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = hung.select("u", F.col("m").alias("v"))
    return own.unionByName(moved).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``links`` (``u``, ``v`` bigint).

    Links may be repeated, in either direction, or from a node to itself (such a link says nothing).
    Without links there are no rows.
    """
    current = stored(links.filter("u <> v").distinct(), "links")
    state = None
    while True:
        digest = current.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("bigint"))
        ).first()
        if digest == state or not digest[0]:
            break
        state = digest
        current = stored(_small_star(_large_star(current)), "links")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())

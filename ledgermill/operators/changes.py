"""Change feeds: rows with ``_action`` (INSERT or DELETE), ``_is_update`` and an order ``_seq``.

An update is a DELETE of the old image and an INSERT of the new one, both with ``_is_update``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.joins import attach
from ledgermill.session import stored

FEED_COLUMNS = ("_action", "_is_update", "_seq", "_copies")
# Rows are few among others if they are at most one in so many.
FEW = 10


def keys_known(keys: Sequence[str]) -> Column:
    """Rows whose key can match another row at all."""
    return reduce(and_, (F.col(key).isNotNull() for key in keys))


def payload(changes: DataFrame) -> list[str]:
    return [name for name in changes.columns if name not in FEED_COLUMNS]


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed that leads from one snapshot of a table to another.

    Equal rows of both snapshots cancel out in one aggregation over whole rows, which combines
    before the shuffle; no key is ever gathered in one place. ``_copies`` counts identical rows.
    What differs is stored, since it is read twice and far smaller than the snapshots.
    """
    columns = old.columns
    differing = (
        old.withColumn("_side", F.lit(-1))
        .unionByName(new.select(*columns).withColumn("_side", F.lit(1)))
        .groupBy(*columns)
        .agg(F.sum("_side").alias("_net"))
        .filter(F.col("_net") != 0)
    )
    net = stored(differing, "diff")
    added = F.col("_net") > 0
    changed = net.select(
        *columns,
        F.when(added, "INSERT").otherwise("DELETE").alias("_action"),
        F.abs("_net").alias("_copies"),
    )
    replaced = (
        net.filter(keys_known(keys))
        .groupBy(*keys)
        .agg(F.bool_or(added).alias("_gains"), F.bool_or(~added).alias("_loses"))
        .filter(F.col("_gains") & F.col("_loses"))
        .select(*keys, F.lit(True).alias("_is_update"))
    )
    return (
        attach(changed, replaced, {key: key for key in keys})
        .withColumn("_is_update", F.coalesce("_is_update", F.lit(False)))
        .withColumn("_seq", F.when(F.col("_action") == "DELETE", 1).otherwise(2).cast("bigint"))
    )


def net_changes(changes: DataFrame, keys: Sequence[str], seq: str = "_seq") -> DataFrame:
    """One row per key: its newest image, an INSERT winning over a DELETE of the same step.

    A key that was also deleted in the feed comes out as an update. Rows with a NULL key match
    nothing, so they are all kept. The maximum of a struct combines before the shuffle, so a key
    with very many changes costs each task one row.
    """
    columns = payload(changes)
    inserted = F.col("_action") == "INSERT"
    newest = F.max(F.struct(F.col(seq).alias("_order"), inserted.alias("_inserted"), *columns))
    # A row with a NULL key gets a number of its own and so is a group of one; which number does not matter.
    marked = changes.withColumn("_lone", F.when(~keys_known(keys), F.monotonically_increasing_id()))
    replaces = F.when(F.col("_lone").isNotNull(), F.col("_updates")).otherwise(
        F.col("_newest._inserted") & (F.col("_updates") | F.col("_deletes"))
    )
    return (
        marked.groupBy(*keys, "_lone")
        .agg(newest.alias("_newest"), F.bool_or("_is_update").alias("_updates"), F.bool_or(~inserted).alias("_deletes"))
        .select(
            *(F.col(f"_newest.{name}").alias(name) for name in columns),
            F.when(F.col("_newest._inserted"), "INSERT").otherwise("DELETE").alias("_action"),
            replaces.alias("_is_update"),
        )
    )


def net_stored_changes(changes: DataFrame, keys: Sequence[str], seq: str = "_seq") -> DataFrame:
    """``net_changes`` of a stored table, where most keys have one row, which is its own newest image.

    Hashes of the keys, cut to 48 bits, are counted first; only rows whose hash occurs again are aggregated whole, and the
    result is stored. If these are many, all rows are.
    """
    hashed = changes.withColumn("_hash", F.shiftrightunsigned(F.xxhash64(*keys), 16))
    counts = hashed.filter(keys_known(keys)).groupBy("_hash").agg(F.count("*").alias("_rows"))
    again = stored(counts.filter(F.col("_rows") > 1), "repeated-keys")
    if (again.agg(F.sum("_rows")).first()[0] or 0) * FEW > changes.count():
        return stored(net_changes(changes, keys, seq), "net")
    columns, inserted, is_update = payload(changes), F.col("_action") == "INSERT", F.col("_is_update")
    same, again = {"_hash": "_hash"}, again.select("_hash")
    once = attach(hashed, again, same, "left_anti").select(
        *columns,
        F.when(inserted, "INSERT").otherwise("DELETE").alias("_action"),
        F.when(keys_known(keys), inserted & (is_update | ~inserted)).otherwise(is_update).alias("_is_update"),
    )
    repeated = attach(hashed, again, same, "left_semi").drop("_hash")
    return once.unionByName(stored(net_changes(repeated, keys, seq), "net"))


def change_counts(changes: DataFrame) -> DataFrame:
    """Rows per action and update flag."""
    rows = F.sum("_copies") if "_copies" in changes.columns else F.count("*")
    return changes.groupBy(F.col("_action").alias("action"), F.col("_is_update").alias("is_update")).agg(
        rows.alias("n")
    )

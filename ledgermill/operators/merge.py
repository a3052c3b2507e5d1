"""Merging a change feed into a table, as a function from the old table to the new one.

The target is joined from its own side, so a small feed is broadcast and the target is not
shuffled; a large feed is shuffled against it and hot keys are split. Keys are compared with
plain equality: a NULL key matches nothing and is inserted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.changes import keys_known, net_changes, payload
from ledgermill.operators.joins import attach

DOCUMENT_LINE = ("billing_document", "item")


def merge_cdc(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str] = DOCUMENT_LINE,
    *,
    on_existing_insert: str = "ignore",
    as_of: Column | None = None,
    netted: bool = False,
) -> DataFrame:
    """Target after deletes, updates and inserts.

    A plain INSERT of an existing key is ignored, so loading a file twice changes nothing;
    ``on_existing_insert='upsert'`` overwrites the row instead. If the target has ``created_at``
    and ``updated_at``, they are stamped with ``as_of``. ``netted`` says that the changes are
    the output of ``net_changes`` already.
    """
    if on_existing_insert not in ("ignore", "upsert"):
        raise ValueError("on_existing_insert is 'ignore' or 'upsert'")
    net = changes if netted else net_changes(changes, keys)
    inserted = F.col("_action") == "INSERT"
    overwrite = inserted if on_existing_insert == "upsert" else inserted & F.col("_is_update")
    stamp = F.current_timestamp() if as_of is None else as_of
    return _apply(
        target,
        net,
        keys,
        overwrite=overwrite,
        delete=F.col("_action") == "DELETE",
        insert=inserted,
        stamps={"created_at": stamp, "updated_at": stamp},
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    ignore_action: bool = False,
    netted: bool = False,
) -> DataFrame:
    """Target with every source row overwriting its key or added to it.

    The newest row per key counts. Deleted images are left out of a change feed unless
    ``ignore_action`` treats them like any other row.
    """
    defaults = {"_action": F.lit("INSERT"), "_is_update": F.lit(False), "_seq": F.lit(0)}
    rows = source.withColumns({name: v for name, v in defaults.items() if name not in source.columns})
    if not ignore_action:
        rows = rows.filter(F.col("_action") == "INSERT")
    net = rows if netted else net_changes(rows, keys)
    always = F.lit(True)
    return _apply(target, net, keys, overwrite=always, delete=F.lit(False), insert=always, stamps={})


def _apply(
    target: DataFrame,
    net: DataFrame,
    keys: Sequence[str],
    *,
    overwrite: Column,
    delete: Column,
    insert: Column,
    stamps: Mapping[str, Column],
) -> DataFrame:
    """Conditions are over the columns of ``net``; its rows are unique by known key."""
    same_key = {key: key for key in keys}
    fields = [name for name in payload(net) if name in target.columns]
    prefix = "_new_"
    stamps = {
        name: value.cast(target.schema[name].dataType)
        for name, value in stamps.items()
        if name in target.columns
    }

    partners = net.filter(keys_known(keys)).select(
        *keys,
        *(F.col(name).alias(prefix + name) for name in fields),
        F.coalesce(overwrite, F.lit(False)).alias("_overwrite"),
        F.coalesce(delete, F.lit(False)).alias("_delete"),
    )
    touched = {name: F.col(prefix + name) for name in fields}
    if "updated_at" in stamps:
        touched["updated_at"] = stamps["updated_at"]
    old_rows = (
        attach(target, partners, same_key)
        .filter(~F.coalesce("_delete", F.lit(False)))
        .select(
            *(
                F.when(F.col("_overwrite"), touched[name]).otherwise(F.col(name)).alias(name)
                if name in touched
                else F.col(name)
                for name in target.columns
            )
        )
    )

    # Which keys exist: look only at target rows whose key occurs in the feed, then one row per key.
    feed_keys = net.filter(keys_known(keys)).select(*keys)
    existing = attach(target.select(*keys), feed_keys, same_key, "left_semi").distinct()
    new_rows = attach(net.filter(insert), existing, same_key, "left_anti").select(*fields)
    return old_rows.unionByName(new_rows.withColumns(dict(stamps)), allowMissingColumns=True)

"""Star schema: dimensions kept by key, facts, and the checks of their declared keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.rules import describe, year_month
from ledgermill.operators.changes import keys_known
from ledgermill.operators.joins import attach

FACT_COLUMNS = [
    "billing_document",
    "item",
    "billing_date",
    "billing_qty_in_sku",
    "material",
    "billing_type",
    "assignment",
]


def insert_new(dim: DataFrame, source: DataFrame, key: str, as_of: Column | None = None) -> DataFrame:
    """Dimension plus one source row for each key it lacks; NULL keys are left out."""
    fresh = attach(one_per_key(source, key), dim.select(key).distinct(), {key: key}, "left_anti")
    if "created_at" in dim.columns and "created_at" not in fresh.columns:
        stamp = F.current_timestamp() if as_of is None else as_of
        fresh = fresh.withColumn("created_at", stamp.cast(dim.schema["created_at"].dataType))
    return dim.unionByName(fresh, allowMissingColumns=True)


def one_per_key(source: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """The first row of every known key, ascending by ``order_by`` and then by the row itself.

    The ranking columns are not kept. The minimum of a struct combines before the shuffle, so a
    key with very many rows costs each task one row.
    """
    attributes = [name for name in source.columns if name != key and name not in order_by]
    first = F.min(F.struct(*order_by, *attributes)).alias("_first")
    return (
        source.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(first)
        .select(key, *(F.col(f"_first.{name}").alias(name) for name in attributes))
    )


def scd1_upsert(
    dim: DataFrame | None,
    source: DataFrame,
    key: str,
    order_by: Sequence[str] = (),
    as_of: Column | None = None,
) -> DataFrame:
    """Dimension with one source row of each key written over the old one, new keys added.

    Without ``dim`` the dimension starts empty.
    """
    rows = one_per_key(source, key, order_by)
    if dim is None:
        return rows
    stamp = F.current_timestamp() if as_of is None else as_of
    attributes = [name for name in rows.columns if name != key and name in dim.columns]
    found = rows.select(
        key, *(F.col(name).alias(f"_new_{name}") for name in attributes), F.lit(True).alias("_found")
    )
    replaced = {name: F.col(f"_new_{name}") for name in attributes}
    if "updated_at" in dim.columns:
        replaced["updated_at"] = stamp.cast(dim.schema["updated_at"].dataType)
    kept = attach(dim, found, {key: key}).select(
        *(
            F.when(F.col("_found"), replaced[name]).otherwise(F.col(name)).alias(name)
            if name in replaced
            else F.col(name)
            for name in dim.columns
        )
    )
    added = attach(rows, dim.select(key).distinct(), {key: key}, "left_anti").select(key, *attributes)
    if "created_at" in dim.columns:
        added = added.withColumn("created_at", stamp.cast(dim.schema["created_at"].dataType))
    return kept.unionByName(added, allowMissingColumns=True)


def product_rows(silver: DataFrame) -> DataFrame:
    """Attribute sets of every material with ``_age``, small for the latest dated line.

    A plain hash aggregate that shrinks the lines to a few rows per material.
    """
    far_future = F.lit("9999-12-31").cast("date")
    age = F.datediff(far_future, F.max("billing_date"))
    return (
        silver.filter(F.col("material").isNotNull())
        .groupBy("material", "item_description", "material_group", "product_category")
        .agg(F.coalesce(age, F.lit(2**31 - 1)).alias("_age"))
    )


def dim_product(silver: DataFrame, dim: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """Products as their latest dated line describes them, the first description if there are several."""
    return scd1_upsert(dim, product_rows(silver), "material", ["_age"], as_of)


def billing_type_rows(silver: DataFrame) -> DataFrame:
    return (
        silver.select("billing_type")
        .filter(F.col("billing_type").isNotNull())
        .distinct()
        .withColumn("billing_type_desc", describe(F.col("billing_type")))
    )


def dim_billing_type(
    silver: DataFrame, dim: DataFrame | None = None, as_of: Column | None = None
) -> DataFrame:
    """Billing types seen so far, with their names."""
    rows = billing_type_rows(silver)
    return rows if dim is None else insert_new(dim, rows, "billing_type", as_of)


def date_rows(silver: DataFrame) -> DataFrame:
    days = silver.select(F.col("billing_date").alias("date_key")).filter(F.col("date_key").isNotNull()).distinct()
    day = F.col("date_key")
    return days.withColumns(
        {
            "year": F.year(day).cast("bigint"),
            "quarter": F.quarter(day).cast("bigint"),
            "month": F.month(day).cast("bigint"),
            "month_name": F.monthname(day),
            "week": F.weekofyear(day).cast("bigint"),
            "day": F.dayofmonth(day).cast("bigint"),
            "day_name": F.dayname(day),
            "year_month": year_month(day),
        }
    )


def dim_date(silver: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Days on which something was billed, with their calendar parts."""
    rows = date_rows(silver)
    return rows if dim is None else insert_new(dim, rows, "date_key")


def load_dimensions(
    silver: DataFrame, dims: dict[str, DataFrame] | None = None, as_of: Column | None = None
) -> dict[str, DataFrame]:
    """All three dimensions, brought up to date from the silver lines."""
    old = dims or {}
    return {
        "dim_product": dim_product(silver, old.get("dim_product"), as_of),
        "dim_billing_type": dim_billing_type(silver, old.get("dim_billing_type"), as_of),
        "dim_date": dim_date(silver, old.get("dim_date")),
    }


def fact_sales(gold: DataFrame) -> DataFrame:
    """Fact rows: the netted invoice lines without their descriptive columns."""
    return gold.select(*FACT_COLUMNS, "return_qty", "final_qty", "t_final_amount")


def fact_left_enrich(stage: DataFrame, agg: DataFrame) -> DataFrame:
    """All staged lines with the net quantity of their (document, item), NULL where there is none.

    Several net rows of a key are summed, so every staged line gives one fact row.
    """
    lines = stage.filter(F.col("billing_document").isNotNull()).select(*FACT_COLUMNS)
    keys = ["billing_document", "item"]
    net = agg.groupBy(*keys).agg(F.sum("final_qty").alias("final_qty"))
    return attach(lines, net, {key: key for key in keys}).select(*FACT_COLUMNS, "final_qty")


def fact_totals(stage: DataFrame, totals: DataFrame) -> DataFrame:
    """The fact with a row per line and return, as totals with one row per staged line.

    ``n_rows`` says how many fact rows it stands for and ``final_qty`` what they sum up to, so
    counts and sums over the fact need none of the repeated rows.
    """
    lines = stage.filter(F.col("billing_document").isNotNull()).select(*FACT_COLUMNS)
    return attach(lines, totals, {"billing_document": "billing_document", "item": "item"}).withColumn(
        "n_rows", F.coalesce("n_rows", F.lit(1).cast("bigint"))
    )


def append_once(fact: DataFrame, rows: DataFrame, batch_id: int) -> DataFrame:
    """Append the rows of a batch; loading the same batch again replaces them."""
    others = fact.filter(~F.col("batch_id").eqNullSafe(F.lit(batch_id)))
    return others.unionByName(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), allowMissingColumns=True)


def fk_orphans(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Keys the fact uses and the dimension lacks, with the number of fact rows."""
    used = fact.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("n_rows"))
    return attach(used, dim.select(on).distinct(), {on: on}, "left_anti")


def pk_duplicates(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return (
        frame.filter(keys_known(keys)).groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
    )

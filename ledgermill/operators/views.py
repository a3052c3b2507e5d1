"""Reporting views over the star schema.

The views aggregate the fact by the dimension key first and attach the dimension to the result,
so the fact is never shuffled for a join. Dimension keys are unique (see ``pk_duplicates``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.session import stored


def _documents() -> Column:
    return F.count_distinct("billing_document").alias("total_documents")


def _total(column: str, name: str) -> Column:
    return F.sum(column).alias(name)


def _with_dimension(totals: DataFrame, dim: DataFrame, key: str, dim_key: str, attributes: Sequence[str]) -> DataFrame:
    labels = dim.select(F.col(dim_key).alias(key), *attributes)
    return totals.filter(F.col(key).isNotNull()).join(labels, key)


def sales_by_billing_type(fact: DataFrame, dim_billing_type: DataFrame) -> DataFrame:
    totals = fact.groupBy("billing_type").agg(
        _documents(),
        _total("billing_qty_in_sku", "total_quantity"),
        _total("return_qty", "total_returns"),
        _total("final_qty", "total_final_qty"),
        _total("t_final_amount", "total_final_amount"),
    )
    return _with_dimension(totals, dim_billing_type, "billing_type", "billing_type", ["billing_type_desc"])


def sales_by_product(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    totals = fact.groupBy("material").agg(
        _documents(), _total("final_qty", "total_final_qty"), _total("t_final_amount", "total_final_amount")
    )
    attributes = ["item_description", "product_category", "material_group"]
    return _with_dimension(totals, dim_product, "material", "material", attributes)


def sales_by_date(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    totals = fact.groupBy(F.col("billing_date").alias("date_key")).agg(
        _documents(), _total("final_qty", "total_final_qty"), _total("t_final_amount", "total_final_amount")
    )
    attributes = ["year", "quarter", "month", "month_name", "year_month"]
    return _with_dimension(totals, dim_date, "date_key", "date_key", attributes)


def sales_dashboard(
    fact: DataFrame, dim_date: DataFrame, dim_billing_type: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """Fact rows with their month, type name, category and group.

    Pass dimensions that are stored tables: the planner knows their size then and broadcasts the
    small ones, so that the fact is shuffled for none of them or for the products only.
    """
    days = dim_date.select(F.col("date_key").alias("billing_date"), "year_month")
    types = dim_billing_type.select("billing_type", "billing_type_desc")
    products = dim_product.select("material", "product_category", "material_group")
    return (
        fact.join(days, "billing_date")
        .join(types, "billing_type")
        .join(products, "material")
        .select(
            "billing_document",
            "item",
            "year_month",
            "billing_type_desc",
            "product_category",
            "material_group",
            "billing_qty_in_sku",
            "return_qty",
            "final_qty",
            "t_final_amount",
        )
    )


def billing_teams(fact: DataFrame) -> DataFrame:
    return fact.groupBy("billing_type").agg(_total("final_qty", "total_final_qty"))


def material_teams(fact: DataFrame) -> DataFrame:
    return fact.groupBy("material").agg(_total("final_qty", "total_final_qty"))


def top_products(by_product: DataFrame, n: int = 10) -> DataFrame:
    """Products with the largest net quantity; equal ones by material."""
    return by_product.orderBy(F.col("total_final_qty").desc_nulls_last(), F.col("material").asc()).limit(n)


def latest_dates(by_date: DataFrame, n: int = 30) -> DataFrame:
    return by_date.orderBy(F.col("date_key").desc()).limit(n)


def by_final_qty(fact: DataFrame) -> DataFrame:
    """Fact rows by ascending net quantity, unknown ones last."""
    return fact.orderBy(F.col("final_qty").asc_nulls_last(), "billing_document", "item")


def ranked_by_final_qty(fact: DataFrame) -> DataFrame:
    """``fact`` with ``place``, each row's place by ascending net quantity, unknown ones last, from 1.

    Rows are counted within ranges of the order, and the rows of the ranges before are added.
    """
    order = [F.col("final_qty").asc_nulls_last(), F.col("billing_document"), F.col("item")]
    ranged = stored(fact.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = ranged.withColumn("place", within).join(offsets, "_part")
    return placed.withColumn("place", F.col("place") + F.col("_before")).drop("_part", "_before")


def null_count(fact: DataFrame, column: str = "final_qty") -> DataFrame:
    """Rows of the fact, and those without a net quantity.

    A fact of totals (``n_rows`` per line) counts as the rows it stands for.
    """
    rows = F.col("n_rows") if "n_rows" in fact.columns else F.lit(1).cast("bigint")
    missing = F.when(F.col(column).isNull(), rows).otherwise(0)
    return fact.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(missing), F.lit(0)).alias("n_null_final")
    )


def top_k(frame: DataFrame, column: str, k: int, exact: bool = True, tracked: int = 10_000) -> DataFrame:
    """The k most frequent values and their counts.

    Exact: every value is counted. Otherwise a sketch that tracks at most ``tracked`` values is used;
    a count is then too high by at most the number of rows over ``tracked``. Where values are many and about equally
    frequent, the sketch can't name k of them, and they are counted all the same.
    """
    if not exact:
        sketch = F.call_function("approx_top_k", F.col(column), F.lit(k), F.lit(tracked))
        named = stored(frame.agg(sketch.alias("_top")).select(F.inline("_top")).toDF(column, "n"), "named")
        if named.count() >= k:
            return named
    return (
        frame.groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), F.col(column).asc())
        .limit(k)
    )


def approx_percentile(frame: DataFrame, column: str, p: float, accuracy: int = 10000) -> DataFrame:
    return frame.agg(F.percentile_approx(column, p, accuracy).alias("value"))


def approx_distinct(frame: DataFrame, column: str) -> DataFrame:
    return frame.agg(F.approx_count_distinct(column).alias("n"))


def distinct_sketches(frame: DataFrame, by: str, column: str) -> DataFrame:
    """A mergeable distinct-count sketch per group, to be kept and combined later."""
    return frame.groupBy(by).agg(F.hll_sketch_agg(column).alias("sketch"))


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """Approximate distinct count over all groups of ``distinct_sketches``."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))

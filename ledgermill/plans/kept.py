"""Figures of views and sketches that are kept per bucket and brought up to date from the buckets that changed.

A bucket of the fact or of silver is replaced as a whole, so its part of every figure is made anew and old images need no
retraction. Documents are dealt out to buckets, so numbers of distinct documents simply add up over buckets, exactly.
Reading a figure adds up or merges the parts, a few rows a bucket, and opens neither the fact nor silver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.rules import year_month
from ledgermill.operators.views import top_k
from ledgermill.plans.load import BUCKETED, STATE
from ledgermill.session import stored
from ledgermill.sources.layers import Layers, empty

SALES_SCHEMA = "by string, key string, n_documents bigint, billed bigint, returned bigint, net bigint, amount bigint"
_SUMS = {"billed": "billing_qty_in_sku", "returned": "return_qty", "net": "final_qty", "amount": "t_final_amount"}
# Items that a sketch of frequent values tracks, and the size of a quantile sketch.
TRACKED, QUANTILE_SIZE = 10_000, 400


def _catch_up(
    layers: Layers,
    name: str,
    source: str,
    version: int,
    schema: str,
    summarize: Callable[[DataFrame], DataFrame],
    more: DataFrame | None = None,
) -> None:
    """Bring a kept table to a version of its source; ``summarize`` makes rows with their ``bucket`` from lines with theirs.

    Buckets whose lines changed since the table was last kept are read, and those in ``more``.
    """
    kept = [v for v in layers.versions_of(name) if v <= version]
    if version in kept:
        return
    previous = max(kept, default=None)
    live = layers.live(source, version)
    if previous is None:
        stale = live.select("bucket")
    else:
        seen = layers.live(name, previous).select("bucket", F.col("v").alias("seen"))
        # A few rows on both sides.
        stale = live.join(F.broadcast(seen), "bucket", "left").filter(F.coalesce(F.col("v") > F.col("seen"), F.lit(True))).select("bucket")
        if more is not None:
            stale = stale.unionByName(more.select("bucket"))
    stale = stored(stale.distinct().coalesce(1), "stale-buckets")
    lines = layers.read_buckets(source, version, {**BUCKETED, **STATE}[source], stale).withColumn("bucket", layers.bucket_of())
    layers.write_buckets(summarize(lines), name, version, stale, previous)


def _totals(lines: DataFrame, by: dict[str, Column]) -> DataFrame:
    """Per bucket and value of each of ``by`` the distinct documents and sums, as rows of ``SALES_SCHEMA`` with their bucket."""
    keys = [F.struct(F.lit(name).alias("by"), value.cast("string").alias("key")) for name, value in by.items()]
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    # A document's values come together as sets, one row a document, instead of a row for each of its lines and labels.
    known = lines.filter(F.col("billing_document").isNotNull())
    values = known.groupBy("bucket", "billing_document").agg(*(F.collect_set(key).alias(name) for name, key in zip(by, keys, strict=True)))
    documents = values.select("bucket", F.explode(F.concat(*by)).alias("_key"), one.alias("n_documents"))
    summed = lines.select("bucket", F.explode(F.array(*keys)).alias("_key"), none.alias("n_documents"), *(F.col(c).alias(n) for n, c in _SUMS.items()))
    both = summed.unionByName(documents, allowMissingColumns=True)
    return both.groupBy("bucket", F.col("_key.by").alias("by"), F.col("_key.key").alias("key")).agg(
        F.sum("n_documents").alias("n_documents"), *(F.sum(name).alias(name) for name in _SUMS)
    )


def keep_sales(layers: Layers, version: int) -> None:
    """Figures by billing type, material, day and month, and over all."""
    day = F.col("billing_date")
    by = {"billing_type": F.col("billing_type"), "material": F.col("material"), "date_key": day, "year_month": year_month(day), "all": F.lit("")}
    _catch_up(layers, "kept_sales", "fact_sales", version, SALES_SCHEMA, lambda lines: _totals(lines, by))


def keep_labels(layers: Layers, version: int) -> None:
    """Figures by product category and material group, which the product dimension gives.

    Beside buckets with changed lines those are read that hold products whose labels changed since.
    """
    keep_sales(layers, version)
    labels = ["material", "product_category", "material_group"]
    products = layers.read("dim_product", version).select(*labels)
    kept, more = [v for v in layers.versions_of("kept_labels") if v < version], None
    if kept:
        changed = products.exceptAll(layers.read("dim_product", max(kept)).select(*labels)).select("material")
        held = layers.read_buckets("kept_sales", version, SALES_SCHEMA, bucket=True).filter("by = 'material'")
        more = held.join(changed, held["key"] == changed["material"], "left_semi").select("bucket")
    by = {name: F.col(name) for name in labels[1:]}

    def summarize(lines: DataFrame) -> DataFrame:
        return _totals(lines.join(products, "material"), by).filter(F.col("key").isNotNull())

    _catch_up(layers, "kept_labels", "fact_sales", version, SALES_SCHEMA, summarize, more)


def sales(layers: Layers, version: int) -> DataFrame:
    """All kept figures as of a version, brought up to date first: ``SALES_SCHEMA``, one row for every value of each ``by``."""
    keep_labels(layers, version)
    parts = [layers.read_buckets(name, version, SALES_SCHEMA) for name in ("kept_sales", "kept_labels")]
    rows = parts[0].unionByName(parts[1])
    return rows.groupBy("by", "key").agg(*(F.sum(name).alias(name) for name in ("n_documents", *_SUMS)))


def _view(layers: Layers, version: int, by: str, key: Column, dim: str, dim_key: str, attributes: list[str]) -> DataFrame:
    totals = sales(layers, version).filter((F.col("by") == by) & F.col("key").isNotNull())
    named = totals.select(
        key.alias(dim_key),
        F.col("n_documents").alias("total_documents"),
        F.col("billed").alias("total_quantity"),
        F.col("returned").alias("total_returns"),
        F.col("net").alias("total_final_qty"),
        F.col("amount").alias("total_final_amount"),
    )
    return named.join(layers.read(dim, version).select(dim_key, *attributes), dim_key)


def sales_by_billing_type(layers: Layers, version: int) -> DataFrame:
    """The view of the same name, from kept figures."""
    return _view(layers, version, "billing_type", F.col("key"), "dim_billing_type", "billing_type", ["billing_type_desc"])


def sales_by_product(layers: Layers, version: int) -> DataFrame:
    """The view of the same name, from kept figures."""
    attributes = ["item_description", "product_category", "material_group"]
    return _view(layers, version, "material", F.col("key"), "dim_product", "material", attributes).drop("total_quantity", "total_returns")


def sales_by_date(layers: Layers, version: int) -> DataFrame:
    """The view of the same name, from kept figures."""
    attributes = ["year", "quarter", "month", "month_name", "year_month"]
    return _view(layers, version, "date_key", F.col("key").cast("date"), "dim_date", "date_key", attributes).drop("total_quantity", "total_returns")


# Sketches of silver

SKETCH_SCHEMA = "documents binary, quantities binary, materials {}"


def _sketches(lines: DataFrame) -> DataFrame:
    return lines.groupBy("bucket").agg(
        F.hll_sketch_agg("billing_document").alias("documents"),
        F.call_function("kll_sketch_agg_bigint", F.col("billing_qty_in_sku"), F.lit(QUANTILE_SIZE)).alias("quantities"),
        F.call_function("approx_top_k_accumulate", F.col("material"), F.lit(TRACKED)).alias("materials"),
    )


def kept_sketches(layers: Layers, version: int) -> DataFrame:
    """One row of sketches per bucket of silver, brought up to date first."""
    lines = empty(layers.spark, f"{BUCKETED['silver']}, bucket int")
    schema = SKETCH_SCHEMA.format(_sketches(lines).schema["materials"].dataType.simpleString())
    _catch_up(layers, "kept_sketches", "silver", version, schema, _sketches)
    return layers.read_buckets("kept_sketches", version, schema)


def approx_figures(layers: Layers, version: int, p: float = 0.7, k: int = 3) -> DataFrame:
    """One row from merged sketches: about how many documents there are, about the p-quantile of quantities, and about the k
    most frequent materials with their numbers. Without lines there are 0 documents, no quantile and no materials.

    A sketch names only materials that are surely more frequent than its error. If these are fewer than k, since materials
    are many and about equally frequent, they are counted in silver instead.
    """
    quantile = F.call_function("kll_sketch_get_quantile_bigint", F.col("_quantities"), F.lit(p))
    sketches = kept_sketches(layers, version)
    merged = sketches.agg(
        F.hll_sketch_estimate(F.hll_union_agg("documents")).alias("n_documents"),
        F.call_function("kll_merge_agg_bigint", F.col("quantities")).alias("_quantities"),
        F.call_function("approx_top_k_combine", F.col("materials"), F.lit(TRACKED)).alias("_materials"),
    )
    # A sketch counts nulls as a value of its own.
    counted = F.call_function("approx_top_k_estimate", F.col("_materials"), F.lit(k + 1))
    top = F.slice(F.filter(counted, lambda one: one["item"].isNotNull()), 1, k)
    figures = merged.select("n_documents", quantile.alias("quantile"), top.alias("materials"))
    if sketches.isEmpty():
        none = "n_documents bigint, quantile bigint, materials array<struct<item: string, count: bigint>>"
        return layers.spark.createDataFrame([(0, None, [])], none)
    figures = stored(figures, "figures")
    if not figures.filter(F.size("materials") >= k).isEmpty():
        return figures
    lines = layers.read_buckets("silver", version, BUCKETED["silver"]).filter(F.col("material").isNotNull())
    counted = top_k(lines, "material", k).select(F.struct(F.col("material").alias("item"), F.col("n").alias("count")).alias("one"))
    listed = counted.agg(F.sort_array(F.collect_list(F.struct(-F.col("one.count"), F.col("one.item"), "one"))).alias("_all"))
    exact = listed.select(F.transform("_all", lambda one: one["one"]).alias("materials"))
    return figures.drop("materials").crossJoin(exact)  # one row each

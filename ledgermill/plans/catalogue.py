"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill import fixed_values as fx
from ledgermill.functions import clock, rules
from ledgermill.operators import changes as ch
from ledgermill.operators import dashboard as dash
from ledgermill.operators import edits, merge, netting, star, views
from ledgermill.plans import kept, load
from ledgermill.session import all_stored, scratch_path, stored
from ledgermill.sources import adapter, billing_csv, deliveries, files, snapshots
from ledgermill.sources.layers import PACKED, Layers
from ledgermill.streaming.refresh import parquet_stream, start_refresh

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE = ("billing_document", "item")
UPSERT_KEY = ("billing_document", "item", "material", "billing_type")
FLAT = [*LINE, "billing_type", "billing_qty_in_sku"]
# Buckets of the stored layers, few because the given tables are small.
BUCKETS = 8
# Day from which the files of the ledger example are new.
LEDGER_END = "1998-01-01"
DASH_MONTHS = ["1997-03", "1997-04", "1998-11", "2000-07"]
DASH_CATEGORIES = ["Broiler Feed", "Cattle Feed", "Other"]
DASH_TYPES = ["Sales Invoice"]
SEARCH_TERM = "(pig|fish) feed|brand#1[0-3]"

# Lines entered by hand: an invoice, a return of part of it, an adjustment and an export.
HAND_ENTERED = [
    (910000001, 1, "ZF2", "1996-02-10", 48, "M-0417", "layer mash coarse", "hand", 910000001),
    (910000002, 1, "ZRE", "1996-03-01", 6, "M-0417", "layer mash coarse", "hand", 910000001),
    (910000003, 1, "S1", "1996-03-05", 2, "M-0417", "layer mash coarse", "hand", 910000001),
    (910000004, 1, "ZXP", "1996-04-22", 31, "M-0933", "fish pellets small", "hand", 910000004),
]
# Parts of the allowed error of the sketches: three standard errors of the distinct counts.
DISTINCT_ERROR, MERGED_ERROR = 0.15, 0.05
# Three times the error of a quantile sketch's ranks.
RANK_ERROR = 0.03
TRACKED = 10_000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.silver_lines(spark, sf_dir)


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netting.net_out(_silver(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_sales(_gold(spark, sf_dir))


def _dash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard rows over stored dimensions, whose sizes the planner knows."""
    dims = all_stored(star.load_dimensions(_silver(spark, sf_dir)))
    return views.sales_dashboard(_fact(spark, sf_dir), dims["dim_date"], dims["dim_billing_type"], dims["dim_product"])


def _by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales_by_date(_fact(spark, sf_dir), star.dim_date(_silver(spark, sf_dir)))


def _as_text(lines: DataFrame) -> DataFrame:
    """Billing lines as a delivered file spells them."""
    return lines.withColumn("billing_date", F.date_format("billing_date", "MM/dd/yyyy")).select(
        *(F.col(name).cast("string") for name in fx.BILLING_COLUMNS)
    )


def _lines_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as a stored table, for queries that load them in parts: they are made once, not once a part."""
    return stored(adapter.billing_lines(spark, sf_dir), "lines", **PACKED)


def _two_inboxes(spark: SparkSession, sf_dir: str) -> list[str]:
    """All lines as CSV files in two folders, returns apart; lines are made and written once."""
    inbox = scratch_path(spark, "inbox")
    text = _as_text(adapter.billing_lines(spark, sf_dir)).withColumn("is_return", _is_return())
    text.write.partitionBy("is_return").options(**billing_csv.PACKED_OPTIONS).csv(inbox)
    return [_folder(spark, f"{inbox}/is_return={part}") for part in ("false", "true")]


def _is_return() -> Column:
    return F.col("billing_type").isin(*fx.RETURN_TYPES)


def _folder(spark: SparkSession, path: str) -> str:
    """A folder, made if nothing was written into it."""
    files.make_folder(spark, path)
    return path


# --- ingest -------------------------------------------------------------------------------------


@query
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    spelled = F.when(key % 10 == 1, "NULL").when(key % 10 == 2, "null").when(key % 10 == 3, "")
    brands = adapter.table(spark, sf_dir, "part").withColumn("p_brand", spelled.otherwise(F.col("p_brand")))
    return brands.select("p_partkey", billing_csv.null_tokens(F.col("p_brand")).alias("p_brand"))


@query
def typed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = stored(_as_text(adapter.billing_lines(spark, sf_dir)), "text")
    return billing_csv.split_defects(text)[0]


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines written as CSV files and read back."""
    path = scratch_path(spark, "delivery")
    billing_csv.export_csv(_as_text(adapter.billing_lines(spark, sf_dir)), path)
    good, _ = billing_csv.read_billing_csv(spark, path)
    return good.select(*fx.BILLING_COLUMNS)


@query
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoilt = F.when(F.col("assignment").cast("bigint") % 50 == 0, "bad").otherwise(F.col("billing_qty_in_sku"))
    text = _as_text(adapter.billing_lines(spark, sf_dir)).withColumn("billing_qty_in_sku", spoilt)
    bad = billing_csv.split_defects(stored(text, "text"), "quarantine")[1]
    return bad.select(*(F.col(name).cast("bigint") for name in LINE), "reason")


@query
def new_files_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months whose delivered files are not in the ledger, which holds the files up to 1997."""
    path = scratch_path(spark, "delivery")
    month = F.coalesce(F.date_format("billing_date", "yyyy-MM"), F.lit("undated"))
    monthly = adapter.billing_lines(spark, sf_dir).withColumn("month", month)
    monthly.repartition("month").write.partitionBy("month").option("header", True).csv(path)
    found = deliveries.delivered_files(spark, path)
    month_of = F.regexp_extract("path", "/month=([^/]+)/", 1)
    ledger = deliveries.record_files(
        deliveries.empty_ledger(spark), found.filter(month_of < F.lit(LEDGER_END[:7])), fx.FIRST_BATCH_ID
    )
    return deliveries.new_files(found, ledger).select(month_of.alias("month")).distinct()


@query
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows per batch after two loads."""
    out = scratch_path(spark, "layers")
    for inbox in _two_inboxes(spark, sf_dir):
        load.run(spark, inbox, out, buckets=BUCKETS)
    layers = Layers(spark, out, BUCKETS)
    bronze = load.layer(layers, "bronze", layers.latest())
    return bronze.groupBy("batch_id").agg(F.count("*").alias("n_rows"))


@query
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapter.billing_lines(spark, sf_dir)
    schema = "billing_document bigint, item bigint, billing_type string, billing_date string, billing_qty_in_sku bigint, material string, item_description string, material_group string, assignment bigint"
    by_hand = spark.createDataFrame(HAND_ENTERED, schema).withColumn("billing_date", F.to_date("billing_date"))
    return (
        edits.append_rows(lines, by_hand)
        .groupBy("billing_type")
        .agg(F.count("*").alias("n_rows"), F.sum("billing_qty_in_sku").alias("total_qty"))
    )


@query
def evolve_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = edits.evolve_schema(adapter.billing_lines(spark, sf_dir), {"final_qty": "bigint"})
    new = _gold(spark, sf_dir).select(*fx.BILLING_COLUMNS, "final_qty")
    return (
        old.unionByName(new)
        .groupBy("billing_type")
        .agg(F.count("*").alias("n_rows"), F.count_if(F.col("final_qty").isNull()).alias("n_null_final"))
    )


@query
def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, gold = _silver(spark, sf_dir), _gold(spark, sf_dir)
    tables = {
        "bronze": adapter.billing_lines(spark, sf_dir),
        "silver": silver,
        "gold": gold,
        "fact_sales": star.fact_sales(gold),
        **star.load_dimensions(silver),
    }
    return load.layer_row_counts(tables)


@query
def raw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.billing_lines(spark, sf_dir)


# --- projections, predicates, edits ---------------------------------------------------------------


@query
def rename_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = edits.rename_prefix(adapter.billing_lines(spark, sf_dir), "", "z2_")
    return edits.rename_prefix(second, "z2_", "z3_")


@query
def filter_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = (
        (F.col("billing_type") == "ZF2")
        & (F.col("material_group") == "Brand#13")
        & (F.col("billing_qty_in_sku") == 20)
    )
    return adapter.billing_lines(spark, sf_dir).filter(wanted).select(*FLAT)


@query
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.billing_lines(spark, sf_dir).filter(rules.one_of("billing_type", fx.RETURN_TYPES)).select(*FLAT)


@query
def null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.null_count(_team_fact(spark, sf_dir))


@query
def update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = (F.col("billing_type") == "ZF2") & (F.col("material_group") == "Brand#13")
    return edits.update_where(
        adapter.billing_lines(spark, sf_dir), wanted, {"billing_qty_in_sku": F.lit(600).cast("bigint")}
    ).select(*LINE, "billing_qty_in_sku")


@query
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.col("billing_date") < F.lit("1999-01-01").cast("date")
    return edits.delete_where(adapter.billing_lines(spark, sf_dir), old).select(*LINE, "billing_qty_in_sku")


# --- rule columns -------------------------------------------------------------------------------


@query
def product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select(*LINE, "product_category")


@query
def data_quality_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select(*LINE, "year_month", "data_quality_flag")


@query
def billing_type_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = rules.describe(F.col("billing_type")).alias("billing_type_desc")
    return adapter.billing_lines(spark, sf_dir).select(*LINE, name)


@query
def final_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir).select(*LINE, "t_final_amount")


@query
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.dq_summary(_silver(spark, sf_dir))


# --- netting ------------------------------------------------------------------------------------


@query
def returns_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netting.returns_agg(_silver(spark, sf_dir))


@query
def gold_netout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir)


@query
def gold_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netting.net_out(_silver(spark, sf_dir), "pairwise")


@query
def gold_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netting.net_out(_silver(spark, sf_dir), "priority")


@query
def gold_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of the old snapshot brought up to date for the changed documents only."""
    before = rules.clean(adapter.merge_target(spark, sf_dir))
    after = rules.clean(adapter.snapshot_after(spark, sf_dir))
    feed = adapter.change_feed(spark, sf_dir).filter(F.col("billing_document") % 10 != 4)
    return load.refresh_gold(netting.net_out(before), after, feed)


@query
def affected_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netting.affected_invoices(adapter.change_feed(spark, sf_dir), _silver(spark, sf_dir))


@query
def unmatched_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netting.unmatched_returns(_silver(spark, sf_dir)).select(*LINE)


# --- star schema --------------------------------------------------------------------------------


@query
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = star.dim_product(_silver(spark, sf_dir)).filter(F.col("material").cast("bigint") % 2 == 0)
    return star.fk_orphans(_fact(spark, sf_dir), products, "material")


@query
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.pk_duplicates(adapter.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_product(_silver(spark, sf_dir))


@query
def dim_product_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of 1995 to 1997, then overwritten by all lines."""
    silver = _silver(spark, sf_dir)
    early = star.dim_product(silver.filter(F.col("billing_date") < F.lit(LEDGER_END).cast("date")))
    outdated = early.withColumn("item_description", F.upper("item_description"))
    return star.dim_product(silver, outdated)


@query
def dim_billing_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_billing_type(_silver(spark, sf_dir))


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(_silver(spark, sf_dir))


@query
def dim_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the products, kept as they are, plus the missing ones."""
    products = star.dim_product(_silver(spark, sf_dir))
    half = products.filter(F.col("material").cast("bigint") % 2 == 0).withColumn("product_category", F.lit("kept"))
    return star.insert_new(half, products, "material")


@query
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir)


@query
def fact_left_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_left_enrich(adapter.billing_lines(spark, sf_dir), netting.net_out(_silver(spark, sf_dir), "pairwise"))


@query
def fact_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches appended, the second one twice."""
    fact = _fact(spark, sf_dir)
    first = fact.filter(F.col("billing_document") % 2 == 0).withColumn("batch_id", F.lit(1001).cast("bigint"))
    second = fact.filter(F.col("billing_document") % 2 == 1)
    loaded = star.append_once(star.append_once(first, second, 1002), second, 1002)
    return loaded.groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.sum("final_qty").alias("total_final_qty"))


@query
def update_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = edits.evolve_schema(
        adapter.billing_lines(spark, sf_dir).select(*star.FACT_COLUMNS), {"final_qty": "bigint"}
    )
    return edits.update_from(lines, _gold(spark, sf_dir), LINE, {"final_qty": "final_qty"})


# --- views --------------------------------------------------------------------------------------


@query
def sales_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dash(spark, sf_dir)


@query
def sales_by_billing_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales_by_billing_type(_fact(spark, sf_dir), star.dim_billing_type(_silver(spark, sf_dir)))


@query
def sales_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales_by_product(_fact(spark, sf_dir), star.dim_product(_silver(spark, sf_dir)))


@query
def sales_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_date(spark, sf_dir)


def _team_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_totals(
        adapter.billing_lines(spark, sf_dir), netting.pairwise_totals(_silver(spark, sf_dir))
    )


@query
def billing_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.billing_teams(_team_fact(spark, sf_dir))


@query
def material_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.material_teams(_team_fact(spark, sf_dir))


@query
def distinct_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select("product_category").distinct()


@query
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.top_products(sales_by_product(spark, sf_dir))


@query
def latest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.latest_dates(_by_date(spark, sf_dir))


@query
def approx_percentile_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.approx_percentile(adapter.billing_lines(spark, sf_dir), "billing_qty_in_sku", 0.7)


def _within(estimate: DataFrame, exact: DataFrame, error: float) -> DataFrame:
    """The exact number and whether an estimate lies within its error."""
    near = F.abs(F.col("n") - F.col("n_exact")) <= error * F.col("n_exact")
    return exact.withColumn("n", estimate.scalar()).select("n_exact", near.alias("within_error"))


@query
def approx_distinct_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapter.billing_lines(spark, sf_dir)
    exact = lines.agg(F.count_distinct("billing_document").alias("n_exact"))
    return _within(views.approx_distinct(lines, "billing_document"), exact, DISTINCT_ERROR)


@query
def approx_distinct_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct documents from one sketch per billing type."""
    lines = adapter.billing_lines(spark, sf_dir)
    exact = lines.agg(F.count_distinct("billing_document").alias("n_exact"))
    sketches = views.distinct_sketches(lines, "billing_type", "billing_document")
    return _within(views.merged_distinct(sketches), exact, MERGED_ERROR)


@query
def top_k_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.top_k(adapter.billing_lines(spark, sf_dir), "billing_document", 3)


@query
def approx_top_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch's counts of its three top values, in order, against the exact top counts."""
    lines = adapter.billing_lines(spark, sf_dir).filter(F.col("material").isNotNull())
    place = F.row_number().over(Window.orderBy(F.col("n").desc(), "material")).alias("place")
    exact = views.top_k(lines, "material", 3).select(place, F.col("n").alias("n_exact"))
    sketch = views.top_k(lines, "material", 3, exact=False, tracked=TRACKED).select(place, "n")
    slack = lines.agg(F.count("*") / TRACKED).scalar()
    near = F.abs(F.col("n") - F.col("n_exact")) <= slack
    return exact.join(sketch, "place").select("place", "n_exact", near.alias("within_error"))


@query
def quantity_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every net quantity of the fact: its rows, and the first place they have in ascending order, unknown ones last."""
    net = netting.net_out(_silver(spark, sf_dir), "pairwise")
    fact = star.fact_left_enrich(adapter.billing_lines(spark, sf_dir), net)
    places = views.ranked_by_final_qty(fact)
    return places.groupBy("final_qty").agg(F.count("*").alias("n_rows"), F.min("place").alias("first_place"))


@query
def quantity_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row of the fact by ascending net quantity, unknown ones last."""
    lines = _lines_once(spark, sf_dir)
    net = netting.net_out(rules.clean(lines), "pairwise")
    fact = star.fact_left_enrich(lines, net)
    return views.ranked_by_final_qty(fact).select("billing_document", "item", "final_qty", "place")


# --- change capture and merge ---------------------------------------------------------------------


@query
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = ch.snapshot_diff(adapter.merge_target(spark, sf_dir), adapter.snapshot_after(spark, sf_dir), LINE)
    return feed.select(*FLAT, F.col("_action").alias("action"), F.col("_is_update").alias("is_update"))


@query
def diff_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table before and after a few orders changed, as stored snapshots: only buckets that differ are compared."""
    old, new = (scratch_path(spark, name) for name in ("old", "new"))
    lines, few = _lines_once(spark, sf_dir), F.col("billing_document") % 997 == 5
    quantity = F.when(few, F.col("billing_qty_in_sku") + 1).otherwise(F.col("billing_qty_in_sku"))
    snapshots.write_snapshot(lines, old, LINE)
    snapshots.write_snapshot(lines.withColumn("billing_qty_in_sku", quantity), new, LINE)
    feed = snapshots.diff_snapshots(spark, old, new, LINE)
    return feed.select(*FLAT, F.col("_action").alias("action"), F.col("_is_update").alias("is_update"))


@query
def net_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = ch.net_changes(adapter.change_feed(spark, sf_dir), LINE)
    return net.select(*FLAT, F.col("_action").alias("action"), F.col("_is_update").alias("is_update"))


@query
def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.change_counts(adapter.change_feed(spark, sf_dir))


def _net(spark: SparkSession, sf_dir: str, keys: tuple[str, ...]) -> DataFrame:
    """The net changes as a stored table, so that the planner knows whether they can be broadcast."""
    return stored(ch.net_changes(adapter.change_feed(spark, sf_dir), keys), "net")


@query
def merge_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = adapter.merge_target(spark, sf_dir)
    return merge.merge_cdc(target, _net(spark, sf_dir, LINE), netted=True).select(*FLAT)


@query
def merge_cdc_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge with re-delivered keys overwriting what is there."""
    target = adapter.merge_target(spark, sf_dir)
    net = _net(spark, sf_dir, LINE)
    return merge.merge_cdc(target, net, on_existing_insert="upsert", netted=True).select(*FLAT)


@query
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = adapter.change_feed(spark, sf_dir).filter(F.col("_action") == "INSERT")
    net = stored(ch.net_changes(images, UPSERT_KEY), "net")
    return merge.merge_upsert(adapter.merge_target(spark, sf_dir), net, UPSERT_KEY, netted=True).select(*FLAT)


# --- runs over stored layers ----------------------------------------------------------------------


@query
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines delivered as CSV, loaded through every layer."""
    inbox = scratch_path(spark, "inbox")
    billing_csv.export_csv(_as_text(adapter.billing_lines(spark, sf_dir)), inbox, packed=True)
    report = load.run(spark, inbox, scratch_path(spark, "layers"), buckets=BUCKETS)
    return report.select("step", "n_rows", "status")


@query
def reset_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers filled from the lines, then emptied."""
    layers = Layers(spark, scratch_path(spark, "layers"), BUCKETS)
    load.refresh(layers, adapter.billing_lines(spark, sf_dir), fx.FIRST_BATCH_ID, None)
    last = fx.FIRST_BATCH_ID + 1
    report = load.reset_layers(layers, fx.FIRST_BATCH_ID, last)
    left = load.layer_row_counts({name: load.layer(layers, name, last) for name in load.RESET_ORDER})
    return report.join(left, "layer").select("layer", "rows_deleted", F.col("n_rows").alias("rows_left"))


def _counts(spark: SparkSession, out: str) -> DataFrame:
    """Rows of every layer in the newest version."""
    layers = Layers(spark, out, BUCKETS)
    newest = layers.latest()
    return load.layer_row_counts({name: load.layer(layers, name, newest) for name in load.RESET_ORDER})


@query
def load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders loaded one after the other, then the second one again, which holds nothing new."""
    out, inboxes = scratch_path(spark, "layers"), _two_inboxes(spark, sf_dir)
    for inbox in (*inboxes, inboxes[1]):
        load.run(spark, inbox, out, buckets=BUCKETS)
    return _counts(spark, out)


@query
def quarantine_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery with spoilt rows: rows loaded, rows kept aside, and the latest batch."""
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "layers")
    spoilt = F.when(F.col("assignment").cast("bigint") % 50 == 0, "bad").otherwise(F.col("billing_qty_in_sku"))
    text = _as_text(adapter.billing_lines(spark, sf_dir)).withColumn("billing_qty_in_sku", spoilt)
    billing_csv.export_csv(text, inbox, packed=True)
    report = load.run(spark, inbox, out, on_error="quarantine", buckets=BUCKETS)
    return report.filter(F.col("step").isin("bronze", "quarantine", "silver")).select("step", "n_rows")


@query
def edited_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update and one delete of loaded lines, as seen in silver, gold and fact."""
    layers = Layers(spark, scratch_path(spark, "layers"), BUCKETS)
    load.completed(load.refresh(layers, adapter.billing_lines(spark, sf_dir), fx.FIRST_BATCH_ID, None))
    load.completed(load.edit(layers, F.col("billing_document") % 10 == 2, {"billing_qty_in_sku": F.col("billing_qty_in_sku") + 1}))
    load.completed(load.edit(layers, F.col("billing_document") % 10 == 1))
    newest = layers.latest()
    sums = []
    for name in ("silver", "gold", "fact_sales"):
        rows = load.layer(layers, name, newest)
        sums.append(
            rows.agg(F.count("*").alias("n_rows"), F.sum("billing_qty_in_sku").alias("quantity")).select(
                F.lit(name).alias("layer"), "n_rows", "quantity"
            )
        )
    return sums[0].unionByName(sums[1]).unionByName(sums[2])


def _deliver(spark: SparkSession, lines: DataFrame, inbox: str, name: str) -> list[str]:
    """Lines as packed CSV files of a given name in a folder; the paths of the files."""
    made = scratch_path(spark, "made")
    billing_csv.export_csv(_as_text(lines), made, packed=True)
    spark.createDataFrame([(1,)], "n int").limit(0).write.mode("append").csv(inbox)  # makes the folder
    for old in files.names_in(spark, inbox):
        if old.startswith(f"{name}-"):
            files.remove(spark, f"{inbox}/{old}")
    paths = []
    for n, part in enumerate(p for p in files.names_in(spark, made) if p.endswith(".csv.gz")):
        paths.append(f"{inbox}/{name}-{n:05}.csv.gz")
        files.rename(spark, f"{made}/{part}", paths[-1])
    return paths


@query
def late_and_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of bronze and silver after a first load; after a file a month old came late; after the first files were replaced
    under their names; after the late files were renamed, which changes nothing; and after all was loaded once more by force."""
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "layers")
    lines, digit = _lines_once(spark, sf_dir), F.col("billing_document") % 10
    counts: list[DataFrame] = []

    def load_and_count(step: str, force: bool = False) -> None:
        load.completed(load.run(spark, inbox, out, buckets=BUCKETS, force=force).collect())
        layers = Layers(spark, out, BUCKETS)
        newest = layers.latest()
        tables = {name: load.layer(layers, name, newest) for name in ("bronze", "silver")}
        counts.append(load.layer_row_counts(tables).select(F.lit(step).alias("step"), "layer", "n_rows"))

    _deliver(spark, lines.filter(digit < 4), inbox, "first")
    load_and_count("first")
    late = _deliver(spark, lines.filter(digit.between(4, 5)), inbox, "late")
    for path in late:
        files.set_age(spark, path, datetime.now() - timedelta(days=30))
    load_and_count("late")
    _deliver(spark, lines.filter(digit.between(6, 8)), inbox, "first")
    load_and_count("replaced")
    for n, path in enumerate(late):
        files.rename(spark, path, f"{inbox}/renamed-{n:05}.csv.gz")
    load_and_count("renamed")
    load_and_count("forced", force=True)
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


@query
def edited_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, of which the second is then deleted, the third set to a quantity of 600 for its invoices, and lines that
    two loads brought fall back to the other one: figures of all layers."""
    layers, quantity = Layers(spark, scratch_path(spark, "layers"), BUCKETS), F.col("billing_qty_in_sku")
    lines, digit = _lines_once(spark, sf_dir), F.col("billing_document") % 10
    update = {"_action": F.lit("INSERT"), "_is_update": F.lit(True), "_seq": F.lit(1).cast("bigint")}
    plain = {**update, "_is_update": F.lit(False)}
    # The second load changes lines of the first, and brings new ones.
    loads = [
        lines.filter(digit < 4).withColumns(plain),
        lines.filter(digit.between(3, 6)).withColumns(update).withColumn("billing_qty_in_sku", quantity + 1000),
        lines.filter(digit > 6).withColumns(plain),
    ]
    for n, rows in enumerate(loads):
        version = fx.FIRST_BATCH_ID + n
        stamped = billing_csv.stamp_batch(rows.withColumn("source_file", F.lit(f"{n}.csv")), version)
        load.completed(load.refresh(layers, stamped, version, version - 1 if n else None))
    load.completed(load.edit_batches(layers, [fx.FIRST_BATCH_ID + 1]))
    six_hundred = {"billing_qty_in_sku": F.lit(600).cast("bigint")}
    load.completed(load.edit_batches(layers, [fx.FIRST_BATCH_ID + 2], condition=F.col("billing_type") == "ZF2", values=six_hundred))
    newest, parts = layers.latest(), []
    for name in ("bronze", "silver", "gold", "fact_sales"):
        rows = load.layer(layers, name, newest)
        kept = rows.agg(
            F.count("*").alias("n_rows"),
            F.sum("billing_qty_in_sku").alias("quantity"),
            (F.sum("return_qty") if "return_qty" in rows.columns else F.lit(None).cast("bigint")).alias("returned"),
        )
        parts.append(kept.select(F.lit(name).alias("layer"), "n_rows", "quantity", "returned"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of changes, delivered in two orders other than their own: silver by last digit of the document, where both
    agree."""
    lines, digit = _lines_once(spark, sf_dir), F.col("billing_document") % 10
    quantity = F.col("billing_qty_in_sku")

    def feed(rows: DataFrame, action: Column, is_update: bool, seq: int) -> DataFrame:
        return rows.withColumns({"_action": action, "_is_update": F.lit(is_update), "_seq": F.lit(seq).cast("bigint")})

    inserted = F.lit("INSERT")
    first = feed(lines, inserted, False, 1)
    second = feed(lines.filter(digit.isin(1, 2, 3)).withColumn("billing_qty_in_sku", quantity + 1), F.when(digit == 2, inserted).otherwise("DELETE"), True, 2)
    third = feed(lines.filter(digit.isin(1, 2)).withColumn("billing_qty_in_sku", quantity + 5), inserted, True, 3)

    def loaded(loads: tuple[DataFrame, ...]) -> DataFrame:
        layers = Layers(spark, scratch_path(spark, "layers"), BUCKETS)
        for n, rows in enumerate(loads):
            version = fx.FIRST_BATCH_ID + n
            load.completed(load.refresh(layers, rows, version, version - 1 if n else None, ordered=True))
        silver = load.layer(layers, "silver", layers.latest())
        return silver.groupBy(digit.alias("digit")).agg(F.count("*").alias("n_rows"), F.sum("billing_qty_in_sku").alias("quantity"))

    # Each order has layers of its own, so both are loaded side by side.
    with ThreadPoolExecutor(2) as pool:
        sums = list(pool.map(inheritable_thread_target(spark)(loaded), ((first, third, second), (third, second, first))))
    return sums[0].join(sums[1], ["digit", "n_rows", "quantity"])


@query
def kept_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of all views, kept up from changed buckets through three loads, an update and a delete."""
    layers = Layers(spark, scratch_path(spark, "layers"), BUCKETS)
    lines, digit = _lines_once(spark, sf_dir), F.col("billing_document") % 10
    for n, some in enumerate((digit < 5, digit.between(5, 7), digit > 7)):
        load.completed(load.refresh(layers, lines.filter(some), fx.FIRST_BATCH_ID + n, fx.FIRST_BATCH_ID + n - 1 if n else None))
        kept.keep_labels(layers, layers.latest())
    load.completed(load.edit(layers, digit == 2, {"billing_qty_in_sku": F.col("billing_qty_in_sku") + 1}))
    load.completed(load.edit(layers, digit == 1))
    return kept.sales(layers, layers.latest())


@query
def kept_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches kept through two loads and merged: the exact number of documents, and whether all lie within their errors."""
    layers = Layers(spark, scratch_path(spark, "layers"), BUCKETS)
    lines, digit = _lines_once(spark, sf_dir), F.col("billing_document") % 10
    for n, some in enumerate((digit < 5, digit >= 5)):
        load.refresh(layers, lines.filter(some), fx.FIRST_BATCH_ID + n, fx.FIRST_BATCH_ID + n - 1 if n else None)
        kept.kept_sketches(layers, layers.latest())
    found = kept.approx_figures(layers, layers.latest(), 0.7, 1)
    quantity, top = F.col("billing_qty_in_sku"), F.col("materials")[0]
    exact = lines.crossJoin(F.broadcast(found)).agg(  # one row
        F.count_distinct("billing_document").alias("n_exact"),
        F.any_value("n_documents").alias("n_documents"),
        F.avg((quantity < F.col("quantile")).cast("int")).alias("below"),
        F.avg((quantity <= F.col("quantile")).cast("int")).alias("up_to"),
        F.count_if(F.col("material") == top["item"]).alias("n_item"),
        F.any_value(top["count"]).alias("n_top"),
        (F.count("*") / kept.TRACKED).alias("slack"),
    )
    return exact.select(
        "n_exact",
        (F.abs(F.col("n_documents") - F.col("n_exact")) <= F.col("n_exact") * MERGED_ERROR).alias("distinct_ok"),
        ((F.col("below") <= 0.7 + RANK_ERROR) & (F.col("up_to") >= 0.7 - RANK_ERROR)).alias("quantile_ok"),
        (F.abs(F.col("n_item") - F.col("n_top")) <= F.col("slack") * 2).alias("top_ok"),
    )


@query
def small_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines but those of a few orders, then those in a load of their own: gold, returns and products as kept up."""
    layers = Layers(spark, scratch_path(spark, "layers"), BUCKETS)
    lines = _lines_once(spark, sf_dir)
    few = F.col("assignment") % 97 == 5
    for n, rows in enumerate((lines.filter(~few), lines.filter(few))):
        load.refresh(layers, rows, fx.FIRST_BATCH_ID + n, fx.FIRST_BATCH_ID + n - 1 if n else None)
    newest = layers.latest()
    gold = load.layer(layers, "gold", newest)
    dim = load.layer(layers, "dim_product", newest)
    netted = gold.groupBy("material").agg(F.count("*").alias("n_rows"), F.sum("return_qty").alias("returned"), F.sum("final_qty").alias("remaining"))
    return dim.join(netted, "material", "left").select("material", "item_description", "material_group", "product_category", "n_rows", "returned", "remaining")


@query
def empty_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over the same folder finds nothing new and writes no version."""
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "layers")
    billing_csv.export_csv(_as_text(adapter.billing_lines(spark, sf_dir)), inbox, packed=True)
    first = load.run(spark, inbox, out, buckets=BUCKETS).filter("step = 'bronze'")
    second = load.run(spark, inbox, out, buckets=BUCKETS)
    newest = Layers(spark, out, BUCKETS).latest()
    return first.unionByName(second).select("step", "n_rows", "status", F.lit(newest).cast("bigint").alias("newest"))


def _deliver_by_type(spark: SparkSession, text: DataFrame, path: str) -> None:
    """Lines as CSV files named after their billing type; a type too large for one task comes in files of one name, in numbered
    folders."""
    made = scratch_path(spark, "made")
    typed = text.withColumn("of", F.col("billing_type")).hint("rebalance", "billing_type")
    typed.write.partitionBy("of").options(**billing_csv.CSV_OPTIONS).csv(made)
    files.make_folder(spark, f"{path}/00000")
    for folder in (name for name in files.names_in(spark, made) if name.startswith("of=")):
        for n, part in enumerate(p for p in files.names_in(spark, f"{made}/{folder}") if p.endswith(".csv")):
            files.make_folder(spark, f"{path}/{n:05}")
            files.rename(spark, f"{made}/{folder}/{part}", f"{path}/{n:05}/{folder.removeprefix('of=')}.csv")


@query
def rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines delivered under one file name per billing type, typed on reading: rows by type that have a file's name and age."""
    path = scratch_path(spark, "delivery")
    _deliver_by_type(spark, _as_text(adapter.billing_lines(spark, sf_dir)), path)
    good, _ = billing_csv.read_billing_csv(spark, f"{path}/*", batch_id=1007)
    named = F.col("source_file").endswith(".csv") & (F.col("_seq") > 0) & F.col("ingestion_timestamp").isNotNull()
    return good.filter(named).groupBy("billing_type", "batch_id").agg(
        F.count("*").alias("n_rows"), F.count_distinct("source_file").alias("n_files")
    )


@query
def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines arrive in two deliveries, invoices and returns apart; rows per layer at the end."""
    inbox, out, checkpoint = (scratch_path(spark, name) for name in ("inbox", "layers", "offsets"))
    lines, made = adapter.billing_lines(spark, sf_dir), scratch_path(spark, "made")
    lines.withColumn("is_return", _is_return()).write.partitionBy("is_return").options(**PACKED).parquet(made)
    _folder(spark, inbox)
    for part in ("false", "true"):
        delivery = _folder(spark, f"{made}/is_return={part}")
        for name in (name for name in files.names_in(spark, delivery) if name.endswith(".parquet")):
            files.rename(spark, f"{delivery}/{name}", f"{inbox}/{part}-{name}")
        start_refresh(spark, parquet_stream(spark, inbox, lines.schema), out, checkpoint, buckets=BUCKETS).awaitTermination()
    return _counts(spark, out)


# --- dashboard ----------------------------------------------------------------------------------


@query
def dash_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.dash_filter(
        _dash(spark, sf_dir), months=DASH_MONTHS, categories=DASH_CATEGORIES, billing_types=DASH_TYPES
    )


@query
def last3_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.last_months(_dash(spark, sf_dir))


@query
def dash_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows the dashboard opens with: the last three months."""
    return dash.in_last_months(_dash(spark, sf_dir))


@query
def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.kpis(_dash(spark, sf_dir))


@query
def sales_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.sales_trend(_by_date(spark, sf_dir), DASH_MONTHS)


@query
def billing_type_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    lines = star.fact_sales(netting.net_out(silver, invoice_types=tuple(fx.BILLING_TYPE_NAMES)))
    # Codes without a name of their own share one label.
    unknown = F.when(F.col("billing_type") == "ZXP", F.concat(F.lit("X"), F.col("item") % 2)).otherwise(F.col("billing_type"))
    lines, silver = (frame.withColumn("billing_type", unknown) for frame in (lines, silver))
    by_type = views.sales_by_billing_type(lines, star.dim_billing_type(silver))
    return dash.share(by_type, "billing_type_desc", "total_final_qty")


@query
def category_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.category_sales(_dash(spark, sf_dir))


@query
def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.monthly_sales(_dash(spark, sf_dir))


@query
def material_group_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.material_group_sales(_dash(spark, sf_dir))


@query
def search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.search_rows(_dash(spark, sf_dir), SEARCH_TERM)


@query
def detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.detail_rows(_dash(spark, sf_dir), 100)


@query
def detail_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.detail_counts(_dash(spark, sf_dir), SEARCH_TERM, 100)


# --- time ---------------------------------------------------------------------------------------


@query
def convert_tz(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = clock.convert_tz(F.col("ts"), "UTC", "Asia/Kolkata")
    return adapter.table(spark, sf_dir, "events").select("event_id", local.alias("ts_ist"))


@query
def last_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clock.last_hours(adapter.table(spark, sf_dir, "events").select("event_id", "ts"), "ts", 24)


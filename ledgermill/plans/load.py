"""One run over all layers: delivered rows -> silver -> gold -> dimensions -> fact -> views."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import fixed_values as fx
from ledgermill.functions.rules import clean, one_of
from ledgermill.operators import views
from ledgermill.operators.changes import FEW, keys_known, net_changes, net_stored_changes
from ledgermill.operators.edits import update_where
from ledgermill.operators.history import EDITED, as_changes, replayed
from ledgermill.operators.joins import attach
from ledgermill.operators.marks import Marks, marks
from ledgermill.operators.merge import DOCUMENT_LINE, merge_cdc
from ledgermill.operators.netting import net_out
from ledgermill.operators.star import dim_product, fact_sales, load_dimensions
from ledgermill.session import stored
from ledgermill.sources import deliveries
from ledgermill.sources.billing_csv import read_text_rows, split_defects, stamp_batch
from ledgermill.sources.layers import BRONZE_SCHEMA, DEFAULT_BUCKETS, Busy, Layers, column_names, empty

REPORT_SCHEMA = "step string, n_rows bigint, status string, message string"
_STAMPS = "created_at timestamp_ntz, updated_at timestamp_ntz"
_LINE = (
    "billing_document bigint, item bigint, billing_type string, billing_date date, billing_qty_in_sku bigint, "
    "material string, item_description string, material_group string, assignment bigint"
)
_NET = "return_qty bigint, final_qty bigint, t_final_amount bigint"
DIMENSIONS = {
    "dim_product": f"material string, item_description string, material_group string, product_category string, {_STAMPS}",
    "dim_billing_type": "billing_type string, billing_type_desc string, created_at timestamp_ntz",
    "dim_date": "date_key date, year bigint, quarter bigint, month bigint, month_name string, week bigint, "
    "day bigint, day_name string, year_month string",
}
BUCKETED = {
    "silver": f"{_LINE}, product_category string, year_month string, {_STAMPS}, data_quality_flag string",
    "gold": f"{_LINE}, {_NET}, created_at timestamp_ntz",
    "fact_sales": "billing_document bigint, item bigint, billing_date date, billing_qty_in_sku bigint, "
    f"material string, billing_type string, assignment bigint, {_NET}",
}
# Beside the layers: per bucket of silver the latest day of every description of a product; the returns in silver, in
# buckets by the document they are assigned to; and, where changes are kept in their own order, the latest change of a line.
STATE = {
    "products": "material string, item_description string, material_group string, product_category string, billing_date date",
    "returns": BUCKETED["silver"],
    "applied": "billing_document bigint, item bigint, seq bigint",
}
# The order of lines that are there before any change of a load.
_BEFORE_ALL = -(1 << 63)
# Layer tables, those that depend on others first.
RESET_ORDER = ("fact_sales", "gold", "silver", *DIMENSIONS, "bronze")


class RunFailed(RuntimeError):
    """A step failed; the report tells which."""


def completed(report: list[tuple]) -> list[tuple]:
    """The report of a load or an edit, if no step of it failed; the newest version would be one without it."""
    if any(status == "failed" for _, _, status, _ in report):
        raise RunFailed(str(report))
    return report


@dataclass
class BatchEdit:
    """Earlier loads to be replaced: the rows they have from now on, and the rows that went or came."""

    loads: DataFrame
    rows: DataFrame
    changed: DataFrame


def as_feed(delivered: DataFrame) -> DataFrame:
    """Delivered rows as a change feed: plain inserts unless they say otherwise."""
    defaults = {
        "_action": F.lit("INSERT"),
        "_is_update": F.lit(False),
        "_seq": F.lit(0).cast("bigint"),
    }
    return delivered.withColumns(
        {name: value for name, value in defaults.items() if name not in delivered.columns}
    )


def bronze_to_silver(silver: DataFrame, net: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Silver after the net changes, with category, month and quality flag of every new image."""
    moment = F.current_timestamp() if as_of is None else as_of
    return merge_cdc(silver, clean(net), DOCUMENT_LINE, as_of=moment, netted=True)


def touched_documents(images: DataFrame) -> DataFrame:
    """Documents whose net quantities may differ after a change, given all old and new images."""
    return _named_documents(images).distinct()


def _named_documents(images: DataFrame) -> DataFrame:
    """The touched documents as often as they are named."""
    own = images.select("billing_document")
    assigned = images.filter(one_of("billing_type", fx.RETURN_TYPES)).select(
        F.col("assignment").alias("billing_document")
    )
    return own.unionByName(assigned).filter(F.col("billing_document").isNotNull())


_IMAGE = ("billing_document", "billing_type", "assignment")


def _old_images(before: DataFrame, net: DataFrame) -> DataFrame:
    """Old images of the changed lines, as far as the netting looks at them."""
    keys = net.select(*DOCUMENT_LINE).distinct()
    return attach(before.select("item", *_IMAGE), keys, {key: key for key in DOCUMENT_LINE}, "left_semi").select(*_IMAGE)


def _images(before: DataFrame, net: DataFrame) -> DataFrame:
    """Old and new images of the changed lines, as far as the netting looks at them."""
    return net.select(*_IMAGE).unionByName(_old_images(before, net))


def _with_rest(rows: DataFrame, rest: DataFrame | None) -> DataFrame:
    return rows if rest is None else rows.unionByName(rest)


def refresh_gold(
    gold: DataFrame, silver: DataFrame, images: DataFrame, returns: DataFrame | None = None, touched: DataFrame | None = None
) -> DataFrame:
    """Gold with only the touched documents netted again.

    ``images`` holds the old and the new image of every changed line. Equal to netting all of
    ``silver``, but the join runs over the touched documents alone. If ``gold`` and ``silver``
    are cut down to parts that hold the touched documents, pass all ``returns`` beside them. ``touched``
    are these documents, if they are stored already.
    """
    # Only stored documents are cheap to look at twice.
    hits = Marks(None) if touched is None else marks(touched, ["billing_document"])
    touched = touched_documents(images) if touched is None else touched
    document = {"billing_document": "billing_document"}
    near, rest = hits.split(gold, ["billing_document"])
    kept = _with_rest(attach(near, touched, document, "left_anti"), rest)
    lines = hits.likely(silver.filter(one_of("billing_type", fx.INVOICE_TYPES)), ["billing_document"])
    invoices = attach(lines, touched, document, "left_semi")
    returned = (silver if returns is None else returns).filter(one_of("billing_type", fx.RETURN_TYPES))
    assigned = attach(hits.likely(returned, ["assignment"]), touched, {"assignment": "billing_document"}, "left_semi")
    return kept.unionByName(net_out(invoices.unionByName(assigned)))


def product_days(lines: DataFrame) -> DataFrame:
    """Per bucket and description of a product the latest day it was billed: all that the product dimension looks at."""
    described = ["material", "item_description", "material_group", "product_category"]
    return lines.filter(F.col("material").isNotNull()).groupBy("bucket", *described).agg(F.max("billing_date").alias("billing_date"))


def refresh(
    layers: Layers,
    delivered: DataFrame | None,
    version: int,
    previous: int | None,
    as_of: Column | None = None,
    skip_empty: bool = True,
    load_key: str | None = None,
    quarantined: DataFrame | None = None,
    batch_edit: BatchEdit | None = None,
    entries: DataFrame | None = None,
    ordered: bool = False,
) -> list[tuple]:
    """Write version ``version`` of every layer from ``previous`` and the delivered rows.

    Of silver, gold, fact, returns and products only the buckets with changed documents are read and written; a table that
    only gains rows is written these alone, beside those it has.
    The report counts the rows written. It stops at the first failing step; without new rows nothing is
    written. With ``ordered``, from the first load on, changes count in the order of their ``_seq`` whatever load
    brings them, so any order of the same loads gives the same lines; without it loads count as they come.
    ``quarantined`` rows are stored beside the layers and counted in the report. Instead of delivered
    rows there may be a ``batch_edit``. ``entries`` are the files that the ledger then counts as loaded. A
    version counts once all steps are done, when it is recorded as the work of ``load_key``; until then no
    other load can write it.
    """
    if (layers.latest() or version) > version:
        raise RunFailed(f"version {version} is older than {layers.latest()}, which builds on it or replaces it")
    moment = (F.current_timestamp() if as_of is None else as_of).cast("timestamp_ntz")
    if previous is not None and not layers.has_buckets("silver", previous):
        raise RunFailed(f"version {previous} of the silver layer does not exist")
    key = load_key or f"version:{version}"
    since = version if previous is None else layers.since(previous) or previous
    kept_in_order = previous is not None and layers.has_buckets("applied", previous)
    if ordered and previous is not None and not kept_in_order:
        raise RunFailed("changes can be kept in their own order from the first load on only")
    ordered = ordered or kept_in_order
    made: dict[str, DataFrame] = {}
    made_marks = {"lines": Marks(None)}
    grown: set[str] = set()
    schemas = {**BUCKETED, **STATE}

    def current(table: str, at: int | None, only: DataFrame | None = None) -> DataFrame:
        if at is None:
            return empty(layers.spark, schemas[table])
        return layers.read_buckets(table, at, schemas[table], only)

    def rewrite(
        table: str, rows: DataFrame, touched: DataFrame, by: str = "billing_document", together: bool = False, grow: bool = False
    ) -> DataFrame:
        names = [*column_names(schemas[table]), *(["bucket"] if "bucket" in rows.columns else [])]
        layers.write_buckets(rows.select(*names), table, version, touched, previous, by, together, grow)
        return layers.written_rows(table, version, schemas[table])

    def only_new() -> bool:
        """Whether no line of silver is gone or other than before."""
        return "fresh" in made and made["found"].isEmpty()

    def marked(keys: DataFrame, n_keys: int) -> Marks:
        """Marks of the lines a version names, by which the lines it surely leaves alone are kept out of joins."""
        made_marks = marks(keys.filter(keys_known(DOCUMENT_LINE)), DOCUMENT_LINE, n_keys)
        if made_marks.table is not None:
            made_marks.table = layers.write(made_marks.table, "marks", version)
        return made_marks

    def bronze() -> DataFrame:
        # Only the rows of this load; the layer is the union of its versions.
        if batch_edit is not None:
            layers.write_moved(batch_edit.loads, version)
            return layers.write_bronze(batch_edit.rows, version)
        layers.forget_moved(version)
        rows = as_feed(delivered)
        if "batch_id" not in rows.columns:
            rows = rows.withColumn("batch_id", F.lit(version).cast("bigint"))
        return layers.write_bronze(rows, version)

    def buckets_of(rows: DataFrame, of: str, document: str = "billing_document") -> DataFrame:
        """Stored, as every table that is read or written by bucket asks for them."""
        return layers.write(layers.buckets_of(rows, document).coalesce(1), f"buckets_{of}", version)

    def lone(rows: DataFrame) -> DataFrame:
        return rows.filter(~keys_known(DOCUMENT_LINE))

    def in_order() -> DataFrame:
        """Silver after a load whose changes count in their own order.

        Lines whose changes are all newer than what was applied go on from how they are; the others, of which something
        newer is known, are made anew from all that bronze holds of them.
        """
        feed = made["bronze"]
        made["touched"] = touched = layers.buckets_of(feed)
        came = feed.filter(keys_known(DOCUMENT_LINE)).groupBy(*DOCUMENT_LINE).agg(F.min("_seq").alias("first"), F.max("_seq").alias("seq"))
        same = {name: name for name in DOCUMENT_LINE}
        hits = made_marks["lines"] = Marks(None) if previous is None else marked(feed, feed.count())
        before, rest = hits.split(current("silver", previous, touched), DOCUMENT_LINE)
        old, old_rest = hits.split(current("applied", previous, touched), DOCUMENT_LINE)
        came = layers.write(attach(came, old.withColumnRenamed("seq", "applied"), same), "came", version)
        late = came.filter(F.col("first") <= F.col("applied")).select(*DOCUMENT_LINE)
        timely = came.filter(F.coalesce(F.col("first") > F.col("applied"), F.lit(True))).select(*DOCUMENT_LINE)
        columns = [*fx.BILLING_COLUMNS, "source_file", "_action", "_is_update", "_seq"]
        there = before.select(
            *fx.BILLING_COLUMNS,
            F.lit(None).cast("string").alias("source_file"),
            F.lit("INSERT").alias("_action"),
            F.lit(False).alias("_is_update"),
            F.lit(_BEFORE_ALL).alias("_seq"),
        )
        known = there.unionByName(feed.select(*columns)).filter(keys_known(DOCUMENT_LINE))
        if previous is None:
            rows = known
        elif late.isEmpty():
            rows = attach(known, timely, same, "left_semi")
        else:
            history = layers.read_bronze(version, since, touched).select(*columns).filter(keys_known(DOCUMENT_LINE))
            rows = attach(hits.likely(history, DOCUMENT_LINE), late, same, "left_semi")
            if not timely.isEmpty():
                rows = attach(known, timely, same, "left_semi").unionByName(rows)
        now = layers.write(replayed(rows, None, "_seq", previous is None), "now", version)
        net = as_changes(before.select(*fx.BILLING_COLUMNS), now, came.select(*DOCUMENT_LINE))
        alone = net_changes(lone(feed).select(*fx.BILLING_COLUMNS, "_action", "_is_update", "_seq"), DOCUMENT_LINE)
        made["net"] = layers.write(net.unionByName(alone), "changes", version)
        made["images"] = layers.write(_images(before, made["net"]), "images", version)
        applied = old.unionByName(came.select(*DOCUMENT_LINE, "seq")).groupBy(*DOCUMENT_LINE).agg(F.max("seq").alias("seq"))
        rewrite("applied", _with_rest(applied, old_rest), touched)
        return rewrite("silver", _with_rest(bronze_to_silver(before, made["net"], moment), rest), touched)

    def silver() -> DataFrame:
        if ordered and batch_edit is None:
            return in_order()
        # Stored, so that the planner knows how small the changes are when it joins them.
        if batch_edit is None:
            feed = made["bronze"].select(*fx.BILLING_COLUMNS, "_action", "_is_update", "_seq")
            net = net_stored_changes(feed, DOCUMENT_LINE)
            if previous is None:
                # There is nothing to compare with, so the changes are looked at once and every image is in bronze.
                made["touched"] = touched = layers.buckets_of(made["bronze"])
                made["images"] = made["bronze"].select("billing_document", "billing_type", "assignment")
                return rewrite("silver", bronze_to_silver(current("silver", None), net, moment), touched)
            made["net"] = net
            made["touched"] = touched = buckets_of(net, "silver")
            n_changes = made["bronze"].count()
            hits = made_marks["lines"] = marked(net, n_changes)
            before = current("silver", previous, touched)
            near, rest = hits.split(before, DOCUMENT_LINE)
            # Which lines are there is found by their keys; whole lines only meet the changes of lines that are there.
            same = {name: name for name in DOCUMENT_LINE}
            keys = net.filter(keys_known(DOCUMENT_LINE)).select(*DOCUMENT_LINE)
            there = layers.write(attach(near.select(*DOCUMENT_LINE), keys, same, "left_semi").distinct(), "there", version)
            found, fresh = (attach(net, there, same, how) for how in ("left_semi", "left_anti"))
            # Inserting a line that is there, without an update, changes nothing.
            found = layers.write(found, "found", version).filter((F.col("_action") == "DELETE") | F.col("_is_update"))
            made["found"], made["fresh"] = found, fresh
            added = bronze_to_silver(current("silver", None), fresh, moment)
            images = fresh.select(*_IMAGE).unionByName(found.select(*_IMAGE))
            if only_new():
                made["images"] = images
                if layers.can_grow("silver", previous, touched):
                    return rewrite("silver", added, touched, grow=True)
                return rewrite("silver", before.unionByName(added), touched)
            made["images"] = images.unionByName(layers.write(_old_images(near, found), "images", version))
            return rewrite("silver", _with_rest(bronze_to_silver(near, found, moment).unionByName(added), rest), touched)
        made["touched"] = touched = layers.buckets_of(batch_edit.changed)
        history = layers.read_bronze(version, since, touched)
        hits = made_marks["lines"] = marked(batch_edit.changed, batch_edit.changed.count())
        before = current("silver", previous, touched)
        near, rest = hits.split(before.filter(keys_known(DOCUMENT_LINE)), DOCUMENT_LINE)
        if ordered:
            layers.carry_over("applied", version, previous)
        keys = batch_edit.changed.select(*DOCUMENT_LINE)
        now = replayed(hits.likely(history, DOCUMENT_LINE), keys, "_seq" if ordered else "batch_id")
        now = layers.write(now, "now", version)
        made["net"] = layers.write(as_changes(near.select(*fx.BILLING_COLUMNS), now, keys), "changes", version)
        images = _images(near, made["net"]).unionByName(batch_edit.changed.select("billing_document", "billing_type", "assignment"))
        made["images"] = layers.write(images, "images", version)
        # Lines without a whole key can't be told apart, so in the touched buckets all of them come from bronze anew.
        anew = clean(lone(history.filter("_action = 'INSERT'").select(*fx.BILLING_COLUMNS))).withColumns({"created_at": moment, "updated_at": moment})
        kept = _with_rest(bronze_to_silver(near, made["net"], moment), rest)
        return rewrite("silver", kept.unionByName(anew.select(*kept.columns)), touched)

    def returns() -> DataFrame:
        """Returns by the document they are assigned to; only buckets that lose or gain some are rewritten."""
        is_return, names = one_of("billing_type", fx.RETURN_TYPES), column_names(schemas["returns"])
        known = previous is not None and layers.has_buckets("returns", previous)
        if not known:
            lines = made["silver"] if previous is None else current("silver", version)
            return rewrite("returns", lines.filter(is_return).select(*names), layers.every_bucket(), "assignment")
        touched = buckets_of(made["images"].filter(is_return), "returns", "assignment")
        # Lines that were not there before have no old row, and their new one is the change itself.
        changed = made.get("found", made["net"])
        keys = changed.filter(keys_known(DOCUMENT_LINE)).select(*DOCUMENT_LINE)
        same = {name: name for name in DOCUMENT_LINE}
        old = current("returns", previous, touched)
        lines = made["silver"].filter(is_return).select(*names)
        if batch_edit is None:
            alone = lone(changed)
            inserted = (alone.unionByName(made["fresh"]) if "fresh" in made else alone).filter((F.col("_action") == "INSERT") & is_return)
            added = clean(inserted.select(*fx.BILLING_COLUMNS)).withColumns({"created_at": moment, "updated_at": moment})
            if only_new() and layers.can_grow("returns", previous, touched):
                return rewrite("returns", added, touched, "assignment", grow=True)
        else:
            rewritten = layers.bucket_of()
            # At most one row per bucket each.
            old = old.join(F.broadcast(made["touched"]), (rewritten == F.col("bucket")) & ~keys_known(DOCUMENT_LINE), "left_anti")
            added = lone(lines).join(F.broadcast(touched), layers.bucket_of("assignment") == F.col("bucket"), "left_semi")
        near, rest = made_marks["lines"].split(old, DOCUMENT_LINE)
        renewed = attach(made_marks["lines"].likely(lines, DOCUMENT_LINE), keys, same, "left_semi")
        rows = _with_rest(attach(near, keys, same, "left_anti"), rest).unionByName(renewed).unionByName(added.select(*names))
        return rewrite("returns", rows, touched, "assignment")

    def gold() -> DataFrame:
        made["returns"] = returns()
        touched = buckets_of(_named_documents(made["images"]), "gold")
        if previous is None:
            rows = net_out(current("silver", version), returns=current("returns", version))
        else:
            old, lines, returned = (current(*of, touched) for of in (("gold", previous), ("silver", version), ("returns", version)))
            if made["images"].count() * FEW > old.count():
                # Nearly all has to be netted again, so telling the rest apart costs more than it saves.
                rows = net_out(lines, returns=returned)
            else:
                documents = layers.write(touched_documents(made["images"]), "named", version)
                if all(layers.can_grow(name, previous, touched) for name in ("gold", "fact_sales")):
                    netted = attach(old.select("billing_document"), documents, {"billing_document": "billing_document"}, "left_semi")
                    if netted.isEmpty():
                        # Only documents that gold lacks have to be netted.
                        old = current("gold", None)
                        grown.add("gold")
                rows = refresh_gold(old.drop("created_at"), lines, made["images"], returned, documents)
        made["gold buckets"] = touched
        return rewrite("gold", rows.withColumn("created_at", moment), touched, grow="gold" in grown)

    def dimension(name: str) -> Callable[[], DataFrame]:
        def load() -> DataFrame:
            old = (
                empty(layers.spark, DIMENSIONS[name])
                if previous is None
                else layers.read(name, previous)
            )
            lines = made["silver"]
            if name == "dim_product":
                # Types and days are only ever added, so the rewritten buckets are enough for them; a product's latest line
                # may lie in any other bucket, of each of which the latest days are kept.
                known = previous is None or layers.has_buckets("products", previous)
                seen, grow = (lines if known else current("silver", version)).withColumn("bucket", layers.bucket_of()), False
                if known and only_new():
                    # The days known of the bucket still count.
                    days = layers.read_buckets("products", previous, STATE["products"], made["touched"], bucket=True)
                    seen = clean(made["fresh"].filter("_action = 'INSERT'")).withColumn("bucket", layers.bucket_of()).select(*days.columns)
                    grow = layers.can_grow("products", previous, made["touched"])
                    seen = seen if grow else days.unionByName(seen)
                days = product_days(seen)
                rewrite("products", days, made["touched"] if known else layers.every_bucket(), grow=grow)
                lines = current("products", version)
                rows = dim_product(lines, old, moment)
            else:
                rows = load_dimensions(lines, {name: old}, moment)[name]
            return layers.write(rows, name, version)

        return load

    def fact() -> DataFrame:
        # Gold's files hold the rows of a bucket together.
        rows = fact_sales(made["gold"]).withColumn("bucket", layers.bucket_of())
        return rewrite("fact_sales", rows, made["gold buckets"], together=True, grow="gold" in grown)

    def bi_views() -> None:
        register_views(layers, version)

    def quarantine() -> DataFrame:
        return layers.write(quarantined, "quarantine", version)

    # Steps of one group need only earlier groups and run as jobs side by side.
    groups = [
        {"bronze": bronze} if quarantined is None else {"bronze": bronze, "quarantine": quarantine},
        {"silver": silver},
        {"gold": gold, **{name: dimension(name) for name in DIMENSIONS}},
        {"fact_sales": fact},
        {"views": bi_views},
    ]

    def attempt(name: str, step: Callable[[], DataFrame | None]) -> tuple:
        try:
            table = step()
            if table is None:
                return (name, None, "done", "")
            made[name] = table
            return (name, table.count(), "done", "")
        except Exception as error:  # the report is the place where a failed step shows
            return (name, None, "failed", str(error))

    attempt_in_thread = inheritable_thread_target(layers.spark)(attempt)
    report: list[tuple] = []
    layers.claim(version, key)
    try:
        if layers.latest() == version and layers.made_by(key) != version:
            raise Busy(f"version {version} was made by another run in the meantime")
        for group in groups:
            if any(row[2] != "done" for row in report):
                report += [(name, None, "skipped", "an earlier step failed") for name in group]
                continue
            with ThreadPoolExecutor(len(group)) as pool:
                report += list(pool.map(attempt_in_thread, group.keys(), group.values()))
            nothing = all(row[1:3] == (0, "done") for row in report if row[0] in ("bronze", "quarantine"))
            if skip_empty and nothing and batch_edit is None:
                return [("bronze", 0, "skipped", "no new rows")]
        if all(row[2] == "done" for row in report):
            if entries is not None:
                layers.write_files(entries.withColumn("batch_id", F.lit(version).cast("bigint")), version)
            layers.record(key, version, previous, since)
            # Only steps of this version read these.
            for name in ("came", "now", "changes", "there", "found", "images", "marks", "named", "buckets_silver", "buckets_returns", "buckets_gold"):
                layers.drop(name, version)
    finally:
        layers.release(version)
    return report


def run(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    batch_id: int | None = None,
    as_of: Column | None = None,
    on_error: str = "abort",
    buckets: int = DEFAULT_BUCKETS,
    force: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """Load the files under ``in_dir`` whose content was not loaded before as one batch and report every step.

    Which files those are is decided by the ledger beside the layers: late files are loaded, files replaced under
    their name too, and files renamed, copied or touched without a change are not. ``force`` loads all files.
    Batches are numbered without gaps from the first one; a run without new rows uses up no number. ``batch_id``
    states which number is expected; the number of the newest batch is accepted too if there is nothing new.
    Bad rows are kept in the table ``quarantine`` if ``on_error`` says so. With ``ordered`` a file's age, not the
    load it comes with, orders its changes among all others. A second run at the same time is
    refused with ``Busy``.
    """
    layers = Layers(spark, out_dir, buckets)
    expected = next_version(layers)
    if batch_id not in (None, expected, expected - 1):
        raise RunFailed(f"the next batch is {expected}, not {batch_id}")
    nothing = spark.createDataFrame([("bronze", 0, "skipped", "no new rows")], REPORT_SCHEMA)
    ledger = layers.ledger()
    found = deliveries.with_digests(deliveries.new_files(deliveries.delivered_files(spark, in_dir), ledger, force))
    found = stored(found, "found-files")
    # Names of new files are all that reaches the driver.
    chosen = [deliveries.as_path(row.path) for row in deliveries.to_load(found, ledger, force).collect()]
    if chosen and batch_id == expected - 1:
        raise RunFailed(f"the next batch is {expected}, not {batch_id}")
    if not chosen:
        _enter(layers, found)
        return nothing
    good, bad = split_defects(read_text_rows(spark, chosen), on_error)
    quarantined = stamp_batch(bad, expected, as_of) if on_error == "quarantine" else None
    newest = expected - 1 if layers.latest() is not None else None
    report = refresh(
        layers, stamp_batch(good, expected, as_of), expected, newest, as_of, True, f"run:{uuid.uuid4().hex}", quarantined,
        entries=found, ordered=ordered,
    )
    if report[0][2] == "skipped":
        _enter(layers, found)
    return spark.createDataFrame(report, REPORT_SCHEMA)


def _enter(layers: Layers, found: DataFrame) -> None:
    """Enter files that brought nothing new, so that they are not read again, as the work of the newest version."""
    if not found.isEmpty():
        newest = layers.latest() or 0
        layers.write_files(found.withColumn("batch_id", F.lit(newest).cast("bigint")), newest, more=True)


def next_version(layers: Layers) -> int:
    """The number of the next load."""
    newest = layers.latest()
    return fx.FIRST_BATCH_ID if newest is None else newest + 1


def edit(
    layers: Layers, condition: Column, values: Mapping[str, Column] | None = None, as_of: Column | None = None
) -> list[tuple]:
    """Update the lines that meet a condition, or delete them if no ``values`` are given, in every layer.

    The lines are those of the newest version; the edit becomes a change feed, a delivery like any
    other, and the next version. Lines without document or item can't be told apart and are not edited.
    ``edit_batches`` edits lines by the load or file that brought them.
    """
    newest = layers.latest()
    if newest is None:
        raise RunFailed("there is nothing to edit yet")
    known = F.col("billing_document").isNotNull() & F.col("item").isNotNull()
    lines = layer(layers, "silver", newest).filter(condition & known).select(*fx.BILLING_COLUMNS)

    def feed(rows: DataFrame, action: str, seq: int) -> DataFrame:
        return rows.withColumns(
            {"_action": F.lit(action), "_is_update": F.lit(values is not None), "_seq": F.lit(seq).cast("bigint")}
        )

    # Newer than what files brought, whose age is their order.
    now = time.time_ns() // 1_000
    changes = feed(lines, "DELETE", now)
    if values is not None:
        changes = changes.unionByName(feed(update_where(lines, F.lit(True), values), "INSERT", now + 1))
    batch = stamp_batch(changes.withColumn("source_file", F.lit(EDITED)), newest + 1, as_of)
    return refresh(layers, batch, newest + 1, newest, as_of)


def edit_batches(
    layers: Layers,
    batch_ids: Sequence[int] = (),
    source_files: Sequence[str] = (),
    condition: Column | None = None,
    values: Mapping[str, Column] | None = None,
    as_of: Column | None = None,
) -> list[tuple]:
    """Update or delete delivered rows by the load or the file they came with, and bring all layers to what they would be
    if the rows had been delivered so.

    Rows are those of the loads ``batch_ids``, and of files named in ``source_files``; ``condition`` over the columns of
    bronze chooses among them. Without ``values`` they are deleted. The loads' rows are stored again as edited; the lines
    that the chosen rows name are then made anew from all that bronze holds of them, load after load, which reads only
    their buckets. Later edits of single lines keep their stored images, and only apply to lines that are there.
    """
    newest = layers.latest()
    if newest is None:
        raise RunFailed("there is nothing to edit yet")
    version, since = newest + 1, layers.since(newest) or 0
    by_file = F.col("source_file").isin(list(source_files)) if source_files else F.lit(False)
    loads = set(batch_ids)
    if source_files:
        # The ledger knows which loads read a file of the name.
        names = layers.ledger().filter(F.element_at(F.split("path", "/"), -1).isin(list(source_files)))
        loads |= {row.batch_id for row in names.select("batch_id").distinct().collect()}
    chosen = (F.col("batch_id").isin(list(batch_ids)) | by_file) & (F.lit(True) if condition is None else condition)
    chosen = F.coalesce(chosen, F.lit(False))
    own = layers.read_bronze(newest, since, loads=sorted(loads))
    old = own.filter(chosen)
    rows, changed = own.filter(~chosen), old
    if values is not None:
        new = update_where(old, F.lit(True), values)
        rows, changed = rows.unionByName(new), changed.unionByName(new)
    changed = stored(changed.select(*DOCUMENT_LINE, "billing_type", "assignment").distinct(), "edited-rows")
    if changed.isEmpty():
        return [("bronze", 0, "skipped", "no such rows")]
    places = layers.spark.createDataFrame([(n,) for n in sorted(loads)], "load bigint")
    return refresh(
        layers, None, version, newest, as_of, False, f"edit:{version}", batch_edit=BatchEdit(places, rows, changed)
    )


def layer(layers: Layers, name: str, version: int) -> DataFrame:
    """A layer table as of a version; bronze holds all rows delivered since it was last emptied."""
    if name == "bronze":
        return layers.read_bronze(version, layers.since(version) or 0)
    if name in BUCKETED:
        return layers.read_buckets(name, version, BUCKETED[name])
    return layers.read(name, version)


def register_views(layers: Layers, version: int) -> dict[str, DataFrame]:
    """The four reporting views over a stored version, also as temporary views."""
    fact, products, types, days = (layer(layers, name, version) for name in ("fact_sales", *DIMENSIONS))
    made = {
        "vw_sales_by_billing_type": views.sales_by_billing_type(fact, types),
        "vw_sales_by_product": views.sales_by_product(fact, products),
        "vw_sales_by_date": views.sales_by_date(fact, days),
        "vw_sales_dashboard": views.sales_dashboard(fact, days, types, products),
    }
    for name, frame in made.items():
        frame.createOrReplaceTempView(name)
    return made


def layer_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table, counted in one query."""
    counts = [
        frame.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        for name, frame in tables.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def reset_layers(
    layers: Layers, version: int, next_version: int, tables: tuple[str, ...] = RESET_ORDER
) -> DataFrame:
    """Empty every table, dependants first, as a new version, and report the rows dropped.

    A table that cannot be emptied is reported and does not stop the others.
    """
    report = []
    for name in tables:
        try:
            table = layer(layers, name, version)
            n_rows = table.count()
            if name in BUCKETED:
                layers.write_buckets(table.limit(0), name, next_version, layers.every_bucket(), version)
            elif name == "bronze":
                layers.write_bronze(table.limit(0), next_version)
            else:
                layers.write(table.limit(0), name, next_version)
            report.append((name, n_rows, None))
        except Exception as error:  # reported per table
            report.append((name, None, str(error)))
    if all(error is None for name, _, error in report if name in RESET_ORDER):
        for name, schema in STATE.items():
            if not layers.has_buckets(name, version):
                continue
            none = empty(layers.spark, f"{schema}, bucket int")
            layers.write_buckets(none, name, next_version, layers.every_bucket(), version)
        # Bronze counts from here on.
        layers.record(f"reset:{next_version}", next_version, version, next_version)
    return layers.spark.createDataFrame(report, "layer string, rows_deleted bigint, error string")

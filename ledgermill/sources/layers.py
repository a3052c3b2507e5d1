"""Layer tables as Parquet folders: a run builds on version n-1 and writes version n.

Nothing is overwritten while it is read, and a run that is repeated, after a lost driver or by a
replayed micro-batch, writes the same version again.

Small tables are written whole. Large ones are split into buckets by document: a version holds only
the buckets that changed, and a small table says which versions of each are live: one that replaced all
before it, and up to ``MOST_PARTS`` in all if later ones only added rows. Joining that table to the folders
lets Spark skip all others (dynamic partition pruning).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.joins import attach
from ledgermill.session import PACKED
from ledgermill.sources import files
from ledgermill.sources.deliveries import LEDGER_SCHEMA

DEFAULT_BUCKETS = 64
LOAD_SCHEMA = "load_key string, version bigint, previous bigint, since bigint"
BRONZE_SCHEMA = (
    "billing_document bigint, item bigint, billing_type string, billing_date date, billing_qty_in_sku bigint, "
    "material string, item_description string, material_group string, assignment bigint, source_file string, "
    "batch_id bigint, ingestion_timestamp timestamp_ntz, _action string, _is_update boolean, _seq bigint"
)
MOVED_SCHEMA = "load bigint, v bigint"
# Up to so many buckets every task writes its rows of each bucket itself; with more, files would get too small, and rows are
# shuffled so that those of a bucket come together.
DIRECT_BUCKETS = 16
# So many versions of a bucket may be live at once; then it is written whole again, so that its files stay few.
MOST_PARTS = 8
# Touched buckets with fewer rows in all are written whole in any case.
GROW_FROM = 1_000_000


class Busy(RuntimeError):
    """Another writer is at work on the same root."""


def column_names(schema: str) -> list[str]:
    """Names in a schema written as "name type, name type, ..."."""
    return [column.split()[0] for column in schema.split(", ")]


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, in a way the planner sees: the limit lets it drop joins with this frame."""
    return spark.createDataFrame([], schema).limit(0)


def _is_missing(error: AnalysisException, *more: str) -> bool:
    """Whether there is nothing to read. Any other error is one, and not an empty table."""
    return error.getCondition() in ("PATH_NOT_FOUND", *more)


class Layers:
    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS):
        """``buckets`` must stay the same for a root; aim at a few GB of silver rows in each."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    # Whole tables

    def path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v={version}"

    def read(self, table: str, version: int) -> DataFrame:
        return self.spark.read.parquet(self.path(table, version))

    def exists(self, table: str, version: int) -> bool:
        try:
            self.read(table, version)
        except AnalysisException as error:
            # A write that failed leaves a folder without files.
            if not _is_missing(error, "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        return True

    def write(self, frame: DataFrame, table: str, version: int) -> DataFrame:
        frame.write.mode("overwrite").options(**PACKED).parquet(self.path(table, version))
        return self.read(table, version)

    def drop(self, table: str, version: int) -> None:
        """Remove what a version holds of a whole table."""
        files.remove(self.spark, self.path(table, version))

    # Bronze: every version holds the rows of its own load, by bucket; an edited load is stored once more

    def write_bronze(self, rows: DataFrame, version: int) -> DataFrame:
        """Store the rows of a load, or the edited rows of earlier ones, as part of a version."""
        names = column_names(BRONZE_SCHEMA)
        missing = {n: F.lit(None).cast(t) for n, t in (c.split() for c in BRONZE_SCHEMA.split(", ")) if n not in rows.columns}
        placed = rows.withColumns(missing).select(*names).withColumn("bucket", self.bucket_of())
        self._write_placed(placed, self.path("bronze", version))
        return self.spark.read.schema(BRONZE_SCHEMA).parquet(self.path("bronze", version))

    def _write_placed(self, placed: DataFrame, path: str, together: bool = False, by: str = "billing_document") -> None:
        """Write rows that have a ``bucket`` into a folder each, in few files; a very large bucket is split between tasks.

        Sorted by type, a scan for returns skips the row groups that hold only invoices; sorted by document, files are smaller.
        """
        order = [name for name in ("bucket", "billing_type", by) if name in placed.columns]
        direct = together or self.buckets <= DIRECT_BUCKETS
        rows = (placed if direct else placed.hint("rebalance", "bucket")).sortWithinPartitions(*order)
        rows.write.mode("overwrite").options(**PACKED).partitionBy("bucket").parquet(path)

    def write_moved(self, loads: DataFrame, version: int) -> None:
        """Record that the rows of some loads (``load``) are those stored with a version from now on."""
        self.write(loads.select(F.col("load").cast("bigint")).coalesce(1), "bronze_moved", version)

    def forget_moved(self, version: int) -> None:
        """Drop what an edit that failed has recorded under the number of a version."""
        files.remove(self.spark, self.path("bronze_moved", version))

    def moved(self, version: int) -> DataFrame:
        """load and v, where the rows of edited loads are as of a version: one row for every load ever edited."""
        try:
            rows = self.spark.read.schema(MOVED_SCHEMA).parquet(f"{self.root}/bronze_moved")
        except AnalysisException as error:
            if not _is_missing(error):
                raise
            return empty(self.spark, MOVED_SCHEMA)
        # An edit that failed left its record, but no version.
        edits = self.loads().filter(F.col("load_key").startswith("edit:")).select(F.col("version").alias("v"))
        done = edits.unionByName(self.spark.createDataFrame([(version,)], "v bigint")).distinct()
        return rows.filter(F.col("v") <= version).join(done, "v").groupBy("load").agg(F.max("v").alias("v"))

    def read_bronze(self, version: int, since: int = 0, only: DataFrame | None = None, loads: list[int] | None = None) -> DataFrame:
        """Rows of all loads from ``since`` to a version, of all buckets or some, of all loads or some.

        Versions and buckets that are not asked for are not read.
        """
        rows = self.spark.read.schema(f"{BRONZE_SCHEMA}, v bigint, bucket int").parquet(f"{self.root}/bronze")
        rows = rows.filter(F.col("v").between(since, version) & (F.col("batch_id") >= since))
        moved = self.moved(version)
        if loads is not None:
            places = {n: n for n in loads} | {row.load: row.v for row in moved.filter(F.col("load").isin(loads)).collect()}
            rows = rows.filter(F.col("v").isin(sorted(set(places.values()))) & F.col("batch_id").isin(loads))
        if only is not None:
            rows = rows.join(F.broadcast(only), "bucket", "left_semi")
        moved = moved.select(F.col("load").alias("_load"), F.col("v").alias("_place"))
        placed = rows.join(moved, F.col("batch_id") == F.col("_load"), "left")
        return placed.filter(F.coalesce("_place", "batch_id") == F.col("v")).select(*column_names(BRONZE_SCHEMA))

    # Which files were loaded

    def write_files(self, entries: DataFrame, version: int, more: bool = False) -> None:
        """Enter files into the ledger as the work of a version; it counts once the version is recorded."""
        kept = entries.select(*column_names(LEDGER_SCHEMA)).coalesce(1)
        kept.write.mode("append" if more else "overwrite").parquet(self.path("files", version))

    def ledger(self) -> DataFrame:
        """Files that finished loads have read, or found to be known already."""
        try:
            entries = self.spark.read.schema(f"{LEDGER_SCHEMA}, v bigint").parquet(f"{self.root}/files")
        except AnalysisException as error:
            if not _is_missing(error):
                raise
            return empty(self.spark, LEDGER_SCHEMA)
        done = self.loads().select(F.col("version").alias("v")).unionByName(self.spark.createDataFrame([(0,)], "v bigint")).distinct()
        return entries.join(done, "v", "left_semi").select(*column_names(LEDGER_SCHEMA))

    # One writer at a time

    def claim(self, version: int, owner: str) -> None:
        """Take the right to write a version; ``Busy`` if another owner has it.

        A load that is repeated under the same name goes on. What a dead writer left is freed by ``release``.
        """
        place = f"{self.root}/claims/{version}"
        if not files.create_once(self.spark, place, owner) and files.content_of(self.spark, place) != owner:
            raise Busy(f"version {version} is being written by another run; if that run is gone, release the version")

    def release(self, version: int) -> None:
        files.remove(self.spark, f"{self.root}/claims/{version}")

    # Which loads made which versions

    def loads(self) -> DataFrame:
        """One row per finished version: the load that made it, the version before it and the first one whose bronze
        rows still count."""
        try:
            return self.spark.read.schema(LOAD_SCHEMA).parquet(f"{self.root}/loads")
        except AnalysisException as error:
            if not _is_missing(error):
                raise
            return empty(self.spark, LOAD_SCHEMA)

    def latest(self) -> int | None:
        """The newest finished version."""
        return self.loads().agg(F.max("version")).first()[0]

    def made_by(self, load_key: str) -> int | None:
        """The version that a load has made, if it has finished before."""
        return self.loads().filter(F.col("load_key") == load_key).agg(F.max("version")).first()[0]

    def record(self, load_key: str, version: int, previous: int | None, since: int) -> None:
        """Mark a version as finished. Doing so again, by a repeated load, replaces its row."""
        row = self.spark.createDataFrame([(load_key, version, previous, since)], LOAD_SCHEMA)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/loads/load_of={version}")

    def since(self, version: int) -> int | None:
        """The first version whose bronze rows count in a finished version."""
        return self.loads().filter(F.col("version") == version).agg(F.max("since")).first()[0]

    # Tables in buckets

    def _folder(self, table: str) -> str:
        return f"{table}_in_{self.buckets}"

    def bucket_of(self, document: str = "billing_document") -> Column:
        return F.pmod(F.xxhash64(document), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame, document: str = "billing_document") -> DataFrame:
        """The buckets some rows fall into, at most as many rows as there are buckets."""
        return rows.select(self.bucket_of(document).alias("bucket")).distinct()

    def has_buckets(self, table: str, version: int) -> bool:
        return self.exists(f"{self._folder(table)}_live", version)

    def versions_of(self, table: str) -> list[int]:
        """The versions in which a table in buckets was written."""
        names = files.names_in(self.spark, f"{self.root}/{self._folder(table)}_live")
        return sorted(int(name.removeprefix("v=")) for name in names if name.startswith("v="))

    def live(self, table: str, version: int) -> DataFrame:
        """bucket and v: which versions of every bucket are live, at most ``MOST_PARTS`` rows for each."""
        return self.read(f"{self._folder(table)}_live", version)

    def read_buckets(
        self, table: str, version: int, schema: str, only: DataFrame | None = None, bucket: bool = False
    ) -> DataFrame:
        """The live rows as of a version, of all buckets or only of some; with their ``bucket`` if asked for."""
        live = self.read(f"{self._folder(table)}_live", version).filter(F.col("v") >= 0)
        if only is not None:
            live = live.join(only, "bucket", "left_semi")
        rows = self.spark.read.schema(f"{schema}, v bigint, bucket int").parquet(f"{self.root}/{self._folder(table)}")
        # A few rows per bucket, so it can always be broadcast.
        return rows.join(F.broadcast(live), ["v", "bucket"]).select(*column_names(schema), *(["bucket"] if bucket else []))

    def can_grow(self, table: str, version: int, touched: DataFrame) -> bool:
        """Whether rows may be added to the touched buckets beside the live ones of a version."""
        # The filter is what makes Spark open the live folders alone.
        live = self.live(table, version).filter(F.col("v") >= 0).join(F.broadcast(touched), "bucket", "left_semi")
        if (live.groupBy("bucket").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) >= MOST_PARTS:
            return False
        rows = self.spark.read.schema("v bigint, bucket int").parquet(f"{self.root}/{self._folder(table)}")
        return rows.join(F.broadcast(live), ["v", "bucket"]).count() >= GROW_FROM

    def written_rows(self, table: str, version: int, schema: str) -> DataFrame:
        """The rows a version itself holds."""
        return self.spark.read.schema(schema).parquet(self.path(self._folder(table), version))

    def carry_over(self, table: str, version: int, previous: int) -> None:
        """Let a table in buckets be in a version what it was in the one before."""
        folder = self._folder(table)
        self.write(self.read(f"{folder}_live", previous).coalesce(1), f"{folder}_live", version)

    def every_bucket(self) -> DataFrame:
        return self.spark.range(self.buckets).select(F.col("id").cast("int").alias("bucket"))

    def write_buckets(
        self,
        frame: DataFrame,
        table: str,
        version: int,
        touched: DataFrame,
        previous: int | None,
        by: str = "billing_document",
        together: bool = False,
        grow: bool = False,
    ) -> None:
        """Replace the touched buckets by the rows given, which are all the rows they now have, or ``grow`` them by these.

        A bucket left without rows is recorded as changed all the same, so its old rows are gone. Rows that have
        a column ``bucket`` bring their place with them; others go by the document in ``by``. Rows read from a table
        in the same buckets come ``together`` already and are not shuffled again.
        """
        folder = self._folder(table)
        placed = frame if "bucket" in frame.columns else frame.withColumn("bucket", self.bucket_of(by))
        self._write_placed(placed, self.path(folder, version), together, by)
        live = touched.select("bucket", F.lit(version).cast("bigint").alias("v"))
        if previous is not None:
            older = self.read(f"{folder}_live", previous)
            live = live.unionByName(older if grow else attach(older, touched, {"bucket": "bucket"}, "left_anti"))
        self.write(live.coalesce(1), f"{folder}_live", version)

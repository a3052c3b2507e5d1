"""Continuous refresh: every micro-batch of delivered files becomes the next version of all layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgermill.plans.load import RunFailed, next_version, refresh, run
from ledgermill.sources.billing_csv import CSV_OPTIONS, TEXT_SCHEMA, split_defects, stamp_batch, with_lineage
from ledgermill.sources.layers import DEFAULT_BUCKETS, Layers

# The age from which on a stream of files passes files over: none in practice.
_NO_LIMIT = "36500d"


def csv_stream(spark: SparkSession, in_dir: str, **options: str) -> DataFrame:
    """Rows of delivered CSV files as they arrive, still as text; ``start_refresh`` types and checks them.

    Late files are read whatever their time stamps. A file replaced under its name is not seen by a stream of
    files; ``start_watch`` loads it.
    """
    reader = spark.readStream.schema(TEXT_SCHEMA).options(**{**CSV_OPTIONS, "maxFileAge": _NO_LIMIT, **options})
    return with_lineage(reader.csv(in_dir))


def parquet_stream(spark: SparkSession, in_dir: str, schema: StructType, **options: str) -> DataFrame:
    """Typed rows, or rows of a change feed, that arrive as Parquet files."""
    raw = spark.readStream.schema(schema).options(**{"maxFileAge": _NO_LIMIT, **options}).parquet(in_dir)
    return raw if "_seq" in raw.columns else with_lineage(raw)


def start_refresh(
    spark: SparkSession,
    rows: DataFrame,
    out_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    buckets: int = DEFAULT_BUCKETS,
    on_error: str = "abort",
    as_of: Column | None = None,
    reports: list[list[tuple]] | None = None,
    skip_empty: bool = False,
) -> StreamingQuery:
    """Start the query. ``trigger`` defaults to working off what is there and stopping.

    Each micro-batch becomes the version after the newest one, whoever made that. A micro-batch that is
    replayed finds the version it has made and leaves it; one that failed half-way writes it again. A
    failed step fails the query, which resumes from its checkpoint. Rows that come as text are typed here,
    bad ones treated as ``on_error`` says. ``reports`` gets the report of every micro-batch.
    """
    layers = Layers(spark, out_dir, buckets)

    def write_version(batch: DataFrame, epoch: int) -> None:
        load_key = f"{checkpoint}:{epoch}"
        if layers.made_by(load_key) is not None:
            return
        newest, version = layers.latest(), next_version(layers)
        quarantined = None
        if dict(batch.dtypes)["item"] == "string":
            batch, bad = split_defects(batch, on_error)
            quarantined = stamp_batch(bad, version, as_of) if on_error == "quarantine" else None
        report = refresh(
            layers, stamp_batch(batch, version, as_of), version, newest, as_of, skip_empty, load_key, quarantined
        )
        if reports is not None:
            reports.append(report)
        failed = [row for row in report if row[2] == "failed"]
        if failed:
            raise RunFailed(f"{failed[0][0]}: {failed[0][3]}")

    return (
        rows.writeStream.foreachBatch(write_version)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_watch(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    **settings,
) -> StreamingQuery:
    """Load whatever ``in_dir`` holds that was not loaded before, at every trigger, by default every 11 seconds.

    The stream is only the clock. What is new is decided by the ledger of files, so late files and files replaced
    under their name are loaded, and it does not matter which run, watch or stream of this kind loaded the others.
    ``settings`` go to ``run``. A failed step fails the query.
    """

    def load(_: DataFrame, __: int) -> None:
        failed = [row for row in run(spark, in_dir, out_dir, **settings).collect() if row.status == "failed"]
        if failed:
            raise RunFailed(f"{failed[0].step}: {failed[0].message}")

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "11 seconds"}))
        .start()
    )

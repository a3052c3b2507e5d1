"""Session defaults and the shared folder for data that outlives a stage."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Layers and tables between steps are written once and read several times, so fewer bytes are worth more than fast packing.
# The second version of the format stores sorted numbers by their differences.
PACKED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}

_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(app_name: str = "ledgermill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    Shuffle partitions start high and adaptive execution merges the small ones, so one setting
    serves both a test on a laptop and a cluster; skewed partitions are split even when that
    costs one more shuffle.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Recording the call site of every column costs several round trips to the JVM each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="ledgermill-")
    return _local_scratch.name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/ledgermill/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder, with options of the writer, and read it back.

    This cuts the lineage in a way that survives lost executors, and the planner then knows the
    real size: a small table is broadcast, a large one is not, without any hint.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def all_stored(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Several frames stored at the same time, as jobs that share the cluster."""
    spark = next(iter(frames.values())).sparkSession
    store = inheritable_thread_target(spark)(stored)
    with ThreadPoolExecutor(len(frames)) as pool:
        pending = {name: pool.submit(store, frame, name) for name, frame in frames.items()}
        return {name: job.result() for name, job in pending.items()}

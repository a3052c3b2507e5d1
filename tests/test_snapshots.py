from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from ledgermill.operators.changes import snapshot_diff
from ledgermill.sources.snapshots import diff_snapshots, differing_buckets, write_snapshot

KEYS = ("billing_document", "item")


def in_order(frame):
    return sorted((tuple(r) for r in frame.select(sorted(frame.columns)).collect()), key=str)


def test_only_buckets_that_differ_are_read(spark, lines, tmp_path):
    old = lines(*((n, 10, "ZF2", n) for n in range(300)), (None, 10, "S1", 3), (None, 10, "S1", 3))
    new = old.withColumn("billing_qty_in_sku", F.when(F.col("billing_document") == 7, 70).otherwise(F.col("billing_qty_in_sku")))
    paths = [str(tmp_path / name) for name in ("old", "new")]
    for frame, path in zip((old, new), paths, strict=True):
        write_snapshot(frame, path, KEYS, 32)
    (bucket,) = (r.bucket for r in differing_buckets(spark, *paths).collect())
    spoilt = 0
    for path in paths:
        for part in Path(path, "rows").glob("bucket=*/*.parquet"):
            if part.parent.name != f"bucket={bucket}":
                part.write_bytes(b"not to be read")
                part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
                spoilt += 1
    assert spoilt >= 60
    got = diff_snapshots(spark, *paths, KEYS)
    assert in_order(got) == in_order(snapshot_diff(old, new, KEYS))
    assert got.count() == 2


def test_equals_the_diff_of_whole_tables(spark, lines, tmp_path):
    old = lines(*((n, 10, "ZF2", n) for n in range(60)), (None, 10, "S1", 3), (5, 20, "ZF2", 1), (5, 20, "ZF2", 1))
    new = lines(
        *((n, 10, "ZF2", n + (n % 7 == 0)) for n in range(5, 70)),
        (None, 10, "S1", 3), (None, 10, "S1", 3), (5, 20, "ZF2", 1), {"billing_document": 9, "item": 30, "material": None, "item_description": "M-0417"},
    )
    paths = [str(tmp_path / name) for name in ("old", "new")]
    for frame, path in zip((old, new), paths, strict=True):
        write_snapshot(frame, path, KEYS, 4)
    assert in_order(diff_snapshots(spark, *paths, KEYS)) == in_order(snapshot_diff(old, new, KEYS))
    assert diff_snapshots(spark, paths[1], paths[1], KEYS).count() == 0


def test_a_moved_null_changes_the_digest(spark, tmp_path):
    schema = "k bigint, a string, b string"
    for name, row in (("old", (1, "x", None)), ("new", (1, None, "x"))):
        write_snapshot(spark.createDataFrame([row], schema), str(tmp_path / name), ["k"], 2)
    assert differing_buckets(spark, str(tmp_path / "old"), str(tmp_path / "new")).count() == 1

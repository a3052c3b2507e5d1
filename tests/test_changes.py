from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgermill.operators.changes import change_counts, net_changes, net_stored_changes, snapshot_diff
from ledgermill.operators.edits import delete_where, evolve_schema, rename_prefix, update_from, update_where
from ledgermill.operators.merge import merge_cdc, merge_upsert

KEYS = ("k", "i")
FEED = "k int, i int, v string, _action string, _is_update boolean, _seq bigint"


def rows(frame, *columns):
    return sorted((tuple(row) for row in frame.select(*(columns or frame.columns)).collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 1, "c"), (None, 1, "n")], "k int, i int, v string")


def feed(spark, *changes):
    return spark.createDataFrame(list(changes), FEED)


def test_merge_deletes_updates_inserts_and_ignores_redelivery(spark, target):
    changes = feed(
        spark,
        (1, 1, "a", "DELETE", False, 1),
        (2, 1, "b", "DELETE", True, 2),
        (2, 1, "B", "INSERT", True, 2),
        (3, 1, "again", "INSERT", False, 3),
        (4, 1, "d", "INSERT", False, 4),
    )
    assert rows(merge_cdc(target, changes, KEYS)) == rows(
        spark.createDataFrame([(2, 1, "B"), (3, 1, "c"), (4, 1, "d"), (None, 1, "n")], target.schema)
    )
    overwritten = merge_cdc(target, changes, KEYS, on_existing_insert="upsert")
    assert (3, 1, "again") in rows(overwritten)
    with pytest.raises(ValueError):
        merge_cdc(target, changes, KEYS, on_existing_insert="maybe")


def test_merging_the_same_feed_again_changes_nothing(spark, target):
    changes = feed(
        spark, (1, 1, "a", "DELETE", False, 1), (2, 1, "B", "INSERT", True, 2), (4, 1, "d", "INSERT", False, 4)
    )
    once = merge_cdc(target, changes, KEYS)
    assert rows(merge_cdc(once, changes, KEYS)) == rows(once)


def test_null_keys_are_never_matched_but_inserted(spark, target):
    changes = feed(spark, (None, 1, "x", "INSERT", False, 1), (None, 1, "y", "INSERT", False, 1), (None, 1, "n", "DELETE", False, 1))
    merged = merge_cdc(target, changes, KEYS)
    assert [row[2] for row in rows(merged.filter("k is null"))] == ["n", "x", "y"]


def test_newest_image_counts(spark, target):
    changes = feed(
        spark,
        (5, 1, "first", "INSERT", False, 1),
        (5, 1, "first", "DELETE", True, 2),
        (5, 1, "second", "INSERT", True, 2),
        (1, 1, "a", "DELETE", False, 1),
        (1, 1, "reborn", "INSERT", False, 5),
        (2, 1, "late", "INSERT", True, 1),
        (2, 1, "late", "DELETE", False, 9),
    )
    net = {(row.k, row._action, row._is_update): row.v for row in net_changes(changes, KEYS).collect()}
    assert net == {
        (5, "INSERT", True): "second",
        (1, "INSERT", True): "reborn",
        (2, "DELETE", False): "late",
    }
    merged = {row.k: row.v for row in merge_cdc(target, changes, KEYS).filter("k is not null").collect()}
    assert merged == {5: "second", 1: "reborn", 3: "c"}


def test_duplicate_target_rows_are_all_updated(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], "k int, i int, v string")
    merged = merge_cdc(target, feed(spark, (1, 1, "c", "INSERT", True, 1)), KEYS)
    assert rows(merged) == [(1, 1, "c"), (1, 1, "c")]


def test_stamps(spark):
    target = spark.createDataFrame(
        [(1, 1, "a")], "k int, i int, v string"
    ).selectExpr("*", "timestamp_ntz'2020-01-01' as created_at", "timestamp_ntz'2020-01-01' as updated_at")
    changes = feed(spark, (1, 1, "b", "INSERT", True, 1), (2, 1, "n", "INSERT", False, 1))
    merged = merge_cdc(target, changes, KEYS, as_of=F.lit("2025-01-01").cast("timestamp"))
    got = {row.k: (row.v, row.created_at.year, row.updated_at.year) for row in merged.collect()}
    assert got == {1: ("b", 2020, 2025), 2: ("n", 2025, 2025)}


def test_upsert_leaves_deleted_images_out_unless_told(spark, target):
    changes = feed(spark, (1, 1, "gone", "DELETE", False, 2), (2, 1, "B", "INSERT", True, 1), (9, 1, "z", "INSERT", False, 1))
    assert {row.k: row.v for row in merge_upsert(target, changes, KEYS).filter("k is not null").collect()} == {
        1: "a", 2: "B", 3: "c", 9: "z",
    }
    blind = merge_upsert(target, changes, KEYS, ignore_action=True)
    assert blind.filter("k = 1").first().v == "gone"
    plain = merge_upsert(target, target.filter("k = 1").withColumn("v", F.lit("p")), KEYS)
    assert plain.filter("k = 1").first().v == "p"


def test_snapshot_diff_and_merge_are_inverse(spark, target):
    new = spark.createDataFrame([(2, 1, "B"), (3, 1, "c"), (4, 1, None), (None, 1, "n"), (None, 1, "m")], target.schema)
    diff = snapshot_diff(target, new, KEYS)
    assert rows(diff, "k", "v", "_action", "_is_update") == sorted(
        [
            (1, "a", "DELETE", False),
            (2, "b", "DELETE", True),
            (2, "B", "INSERT", True),
            (4, None, "INSERT", False),
            (None, "m", "INSERT", False),
        ],
        key=str,
    )
    assert rows(merge_cdc(target, diff, KEYS)) == rows(new)


def test_snapshot_diff_counts_identical_copies(spark, target):
    tripled = target.unionByName(target.filter("k = 1")).unionByName(target.filter("k = 1"))
    diff = snapshot_diff(target, tripled, KEYS)
    assert rows(diff, "k", "_action", "_copies") == [(1, "INSERT", 2)]
    assert rows(change_counts(diff)) == [("INSERT", False, 2)]


def test_edits(spark, target):
    assert rows(delete_where(target, F.col("k") == 1), "v") == [("b",), ("c",), ("n",)]
    updated = update_where(target, (F.col("k") == 1) & (F.col("v") == "a"), {"v": F.lit("A")})
    assert rows(updated, "v") == [("A",), ("b",), ("c",), ("n",)]
    assert rename_prefix(target, "", "z2_").columns == ["z2_k", "z2_i", "z2_v"]
    assert rename_prefix(rename_prefix(target, "", "z2_"), "z2_", "z3_").columns == ["z3_k", "z3_i", "z3_v"]
    wider = evolve_schema(target, {"w": "bigint"})
    assert wider.schema["w"].dataType.simpleString() == "bigint" and wider.filter("w is null").count() == 4


def test_update_from_takes_one_partner_and_refuses_two(spark, target):
    source = spark.createDataFrame([(1, 10), (3, 30), (7, 70), (7, 71)], "k int, w int")
    wider = evolve_schema(target, {"w": "int"})
    got = {row.v: row.w for row in update_from(wider, source, ["k"], {"w": "w"}).collect()}
    assert got == {"a": 10, "b": None, "c": 30, "n": None}
    twice = source.unionByName(source.filter("k = 1"))
    with pytest.raises(Exception, match="more than one source row"):
        update_from(wider, twice, ["k"], {"w": "w"}).collect()


@pytest.mark.parametrize("n_single", [3, 200])
def test_netting_stored_changes_by_repeated_keys_gives_the_same(spark, n_single):
    odd = [
        (1, 1, "old", "INSERT", False, 1),
        (1, 1, "new", "INSERT", False, 2),
        (2, 1, "b", "DELETE", False, 1),
        (2, 1, "B", "INSERT", None, 1),
        (3, 1, "c", "DELETE", True, 1),
        (4, 1, None, "INSERT", True, None),
        (5, 1, "e", None, None, 1),
        (None, 1, "n", "INSERT", True, 1),
        (None, 1, "n", "INSERT", False, 1),
    ]
    changes = feed(spark, *odd, *((10 + n, n, f"v{n}", "INSERT", False, 1) for n in range(n_single)))
    assert rows(net_stored_changes(changes, KEYS)) == rows(net_changes(changes, KEYS))

"""Lines that a change surely leaves alone take no part in its joins."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgermill import fixed_values as fx
from ledgermill.operators import marks
from ledgermill.plans import load
from ledgermill.sources.layers import Layers

LINE = ["billing_document", "item"]


@pytest.mark.parametrize("most_bits", [marks.MOST_BITS, 4096])
def test_no_partner_is_lost(spark, monkeypatch, most_bits):
    monkeypatch.setattr(marks, "MANY_KEYS", 1)
    monkeypatch.setattr(marks, "MOST_BITS", most_bits)
    keys = spark.range(3000).select((F.col("id") * 7).alias("billing_document"), F.lit(10).alias("item"))
    rows = spark.range(21_000).select(F.col("id").alias("billing_document"), F.lit(10).alias("item"), F.lit("x").alias("other"))
    rows = rows.unionByName(spark.createDataFrame([(None, 10, "x"), (7, None, "x")], "billing_document bigint, item int, other string"))
    near, rest = marks.marks(keys, LINE).split(rows, LINE)
    assert near.columns == rest.columns == rows.columns
    assert near.join(keys, LINE).count() == 3000 and rest.join(keys, LINE).count() == 0
    assert near.count() + rest.count() == 21_002
    assert most_bits == 4096 or rest.count() > 14_000
    assert marks.marks(keys, LINE, 0).split(rows, LINE) == (rows, None)


def state(layers):
    found = {}
    for name in ("silver", "gold", "fact_sales", "dim_product", "dim_date", "returns"):
        rows = layers.read_buckets(name, layers.latest(), load.STATE[name]) if name in load.STATE else load.layer(layers, name, layers.latest())
        found[name] = sorted((tuple(r) for r in rows.drop("created_at", "updated_at").collect()), key=str)
    return found


@pytest.mark.parametrize("ordered", [False, True])
def test_loads_and_edits_with_marks_are_those_without(spark, lines, tmp_path, monkeypatch, ordered):
    def made(name, many):
        monkeypatch.setattr(marks, "MANY_KEYS", many)
        layers = Layers(spark, str(tmp_path / name), 2)
        sold = [(n, 10, "ZF2", 50 + n, {"assignment": n, "material": f"M{n % 7}"}) for n in range(120)]
        back = [(1_000 + n, 10, "ZRE", 1, {"assignment": n, "material": f"M{n % 7}"}) for n in range(0, 120, 3)]
        loose = [(None, 10, "ZRE", 2, {"assignment": 4, "material": "M4"}), (5, None, "ZF2", 3, {"assignment": 5, "material": "M5"})]

        def feed(rows, action, is_update, seq):
            return rows.withColumns({"_action": F.lit(action), "_is_update": F.lit(is_update), "_seq": F.lit(seq).cast("bigint")})

        every = lines(*sold, *back, *loose)
        loads = [
            feed(every, "INSERT", False, 3),
            feed(lines(*sold[:9], *back[:4]).withColumn("billing_qty_in_sku", F.col("billing_qty_in_sku") + 1), "INSERT", True, 5),
            feed(lines(*sold[2:4], *sold[25:27]).withColumn("billing_qty_in_sku", F.lit(7).cast("bigint")), "DELETE", False, 4),
        ]
        # In order, the last load is older than what it meets; without, a batch is deleted instead.
        for n, rows in enumerate(loads if ordered else loads[:2]):
            load.completed(load.refresh(layers, rows, 1001 + n, 1000 + n if n else None, ordered=ordered))
        if not ordered:
            load.completed(load.edit_batches(layers, [1002]))
        return state(layers)

    assert made("with", 1) == made("without", 1 << 40)


def test_lines_that_come_again_unchanged_are_not_merged(spark, lines, tmp_path, monkeypatch):
    merged = []
    merge = load.bronze_to_silver
    monkeypatch.setattr(load, "bronze_to_silver", lambda before, net, *more: merged.append((before, net)) or merge(before, net, *more))
    layers = Layers(spark, str(tmp_path / "out"), 2)
    rows = [(n, 10, "ZF2", 50, {"assignment": n}) for n in range(30)]
    load.completed(load.refresh(layers, lines(*rows), 1001, None))
    load.completed(load.refresh(layers, lines(*rows[:20], (40, 10, "ZF2", 1)), 1002, 1001))
    assert all(before.isEmpty() or net.isEmpty() for before, net in merged)
    assert load.layer(layers, "silver", 1002).count() == 31 and load.layer(layers, "bronze", 1002).count() == 51
    assert load.layer(layers, "gold", 1002).agg(F.sum("billing_qty_in_sku")).first()[0] == 1501
    assert fx.VALID == load.layer(layers, "silver", 1002).filter("billing_document = 40").first().data_quality_flag

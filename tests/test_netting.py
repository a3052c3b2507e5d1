from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill.functions.rules import clean
from ledgermill.operators.netting import affected_invoices, net_out, pairwise_totals, unmatched_returns
from ledgermill.operators.star import fact_left_enrich
from ledgermill.plans.load import refresh_gold


def by_line(frame, *columns):
    return {
        (row.billing_document, row.item): tuple(row[c] for c in columns)
        for row in frame.select("billing_document", "item", *columns).collect()
    }


def test_delivered_sample(lines):
    silver = clean(
        lines(
            (910000011, 10, "ZF2", 64, {"assignment": 910000011}),
            (910000077, 10, "ZRE", 9, {"assignment": 910000011}),
        )
    )
    assert by_line(net_out(silver), "return_qty", "final_qty", "t_final_amount") == {
        (910000011, 10): (9, 55, 55)
    }
    assert silver.select("product_category", "data_quality_flag").distinct().first() == ("Broiler Feed", "VALID")


def test_sum_mode_rules(lines):
    silver = clean(
        lines(
            (1, 10, "ZF2", 100),
            (1, 20, "ZF2", 5),
            (2, 10, "ZF2", -1),
            (3, 10, "ZF2", 8, {"material": "other"}),
            (4, 10, "ZF2", 8, {"item_description": None}),
            (91, 10, "ZRE", 60, {"assignment": 1}),
            (92, 10, "S1", 40, {"assignment": 1, "billing_date": None}),
            (93, 10, "ZRE", 3, {"assignment": 3}),
            (94, 10, "ZRE", 3, {"assignment": 4, "item_description": None}),
            (95, 10, "ZXP", 3, {"assignment": 1}),
            (96, 10, "ZRE", 200, {"assignment": 96}),
        )
    )
    assert by_line(net_out(silver), "return_qty", "final_qty", "t_final_amount") == {
        (1, 10): (100, 0, 100),
        (1, 20): (100, -95, -95),
        (3, 10): (0, 8, 8),
        (4, 10): (0, 8, 8),
    }
    assert {row.billing_document for row in unmatched_returns(silver).collect()} == {93, 94, 96}


def test_pairwise_gives_one_row_per_line(lines):
    silver = clean(
        lines(
            (1, 10, "ZF2", 100),
            (2, 10, "ZF2", -7),
            (91, 10, "ZRE", 60, {"assignment": 1}),
            (92, 10, "S1", None, {"assignment": 1}),
        )
    )
    net = net_out(silver, "pairwise")
    assert by_line(net, "n_returns", "zre_bq", "s1_bq", "final_qty") == {(1, 10): (2, 60, None, 40), (2, 10): (0, None, None, -7)}
    assert by_line(pairwise_totals(silver), "n_rows", "final_qty") == {(1, 10): (2, 140), (2, 10): (1, -7)}


def test_priority_prefers_the_first_return_type(lines):
    silver = lines(
        (1, 10, "ZF2", 100),
        (2, 10, "ZF2", 100),
        (3, 10, "ZF2", 100),
        (4, 10, "ZXP", 100),
        (5, 10, "ZXP", 100),
        (91, 10, "ZRE", 60, {"assignment": 1}),
        (92, 10, "S1", 10, {"assignment": 1}),
        (93, 10, "S1", 10, {"assignment": 2, "item_description": "another"}),
        (94, 10, "ZRE", 30, {"assignment": 94}),
        (95, 10, "ZRE", 30, {"assignment": 4}),
    )
    assert by_line(net_out(silver, "priority"), "zre_bq", "s1_bq", "final_quantity") == {
        (1, 10): (60, 10, 40),
        (2, 10): (None, 10, 90),
        (3, 10): (None, None, 100),
        (4, 10): (30, None, 70),
        (94, 10): (30, None, 0),
    }


def test_a_key_with_many_lines_and_returns_gives_its_lines(lines):
    n = 300
    rows = [(7, item, "ZF2", 10) for item in range(n)]
    rows += [(1000 + k, 1, code, 1, {"assignment": 7}) for k in range(n) for code in ("ZRE", "S1")]
    silver = clean(lines(*rows))
    for mode in ("pairwise", "priority"):
        net = net_out(silver, mode)
        assert net.count() == n
        scans = net._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") + net._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")
        assert scans == 2
    fact = fact_left_enrich(silver, net_out(silver, "pairwise"))
    assert fact.count() == 3 * n
    assert fact.agg({"final_qty": "sum"}).first()[0] == n * (10 - 2 * n)


def feed_of(frame, action, is_update=False):
    return frame.withColumns(
        {"_action": F.lit(action), "_is_update": F.lit(is_update), "_seq": F.lit(1).cast("bigint")}
    )


def test_refreshed_gold_equals_a_full_netting(lines):
    old = clean(
        lines(
            (1, 10, "ZF2", 100),
            (1, None, "ZF2", 50),
            (2, 10, "ZF2", 100),
            (3, 10, "ZF2", 100),
            (4, 10, "ZF2", 100),
            (91, 10, "ZRE", 60, {"assignment": 1}),
            (92, 10, "ZRE", 60, {"assignment": 2}),
        )
    )
    changes = lines(
        (91, 10, "ZRE", 60, {"assignment": 1}),
        (91, 10, "ZRE", 60, {"assignment": 3}),
        (4, 10, "ZF2", 100),
        (5, 10, "ZF2", 7),
    )
    new = clean(
        lines(
            (1, 10, "ZF2", 100),
            (1, None, "ZF2", 50),
            (2, 10, "ZF2", 100),
            (3, 10, "ZF2", 100),
            (5, 10, "ZF2", 7),
            (91, 10, "ZRE", 60, {"assignment": 3}),
            (92, 10, "ZRE", 60, {"assignment": 2}),
        )
    )
    refreshed = refresh_gold(net_out(old), new, changes)
    assert sorted(refreshed.collect(), key=str) == sorted(net_out(new).collect(), key=str)
    hit = affected_invoices(feed_of(changes, "INSERT"), new)
    assert {(row.billing_document, row.item) for row in hit.collect()} == {(1, 10), (1, None), (3, 10), (5, 10)}


def test_an_empty_table_of_returns_shuffles_no_invoice(spark, lines, tmp_path):
    silver = clean(lines(*((n, 10, "ZF2", 50) for n in range(50))))
    silver.limit(0).write.parquet(str(tmp_path / "returns"))
    netted = net_out(silver, returns=spark.read.schema(silver.schema).parquet(str(tmp_path / "returns")))
    assert netted.count() == 50
    assert "SortMergeJoin" not in netted._jdf.queryExecution().executedPlan().toString()

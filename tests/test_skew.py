"""A key that holds a third of all rows: results stay whole and its rows go to several tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgermill.functions.rules import clean
from ledgermill.operators.edits import update_from
from ledgermill.operators.joins import attach
from ledgermill.operators.merge import merge_cdc
from ledgermill.operators.netting import net_out, pairwise_totals, unmatched_returns

N = 120_000


@pytest.fixture(scope="module")
def hot_lines(spark):
    """Every third line belongs to document 7; 300 other documents and document 7 have returns."""
    line = F.col("id")
    document = F.when(line % 3 == 0, 7).otherwise(line + 1000)
    sales = spark.range(N, numPartitions=8).select(
        document.cast("bigint").alias("billing_document"),
        line.alias("item"),
        F.lit("ZF2").alias("billing_type"),
        F.lit("1996-03-14").cast("date").alias("billing_date"),
        F.lit(10).cast("bigint").alias("billing_qty_in_sku"),
        F.lit("M-0417").alias("material"),
        F.lit("Broiler").alias("item_description"),
        F.sha2(line.cast("string"), 256).alias("material_group"),
        document.cast("bigint").alias("assignment"),
    )
    pointed_at = F.when(line == 0, 7).otherwise(line * 3 + 1 + 1000)
    returns = spark.range(300, numPartitions=4).select(
        (line + 9_000_000).alias("billing_document"),
        F.lit(10).cast("bigint").alias("item"),
        F.lit("ZRE").alias("billing_type"),
        F.lit("1996-03-14").cast("date").alias("billing_date"),
        F.lit(4).cast("bigint").alias("billing_qty_in_sku"),
        F.lit("M-0417").alias("material"),
        F.lit("Broiler").alias("item_description"),
        F.lit("g").alias("material_group"),
        pointed_at.cast("bigint").alias("assignment"),
    )
    return clean(sales.unionByName(returns))


def final_plan(frame) -> str:
    """Run a query and return the plan that adaptive execution ended with."""
    rows = frame.selectExpr("bit_xor(xxhash64(*)) as digest", "count(*) as n")
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString()


def test_sum_netting_splits_a_hot_document(spark, hot_lines, small_partitions):
    gold = net_out(hot_lines)
    assert "SortMergeJoin(skew=true)" in final_plan(gold)
    hot = N // 3
    assert gold.agg(F.sum("final_qty")).first()[0] == N * 10 - hot * 4 - 299 * 4
    assert gold.count() == N


def test_pairwise_netting_splits_a_hot_document(spark, hot_lines, small_partitions):
    pairs = net_out(hot_lines, "pairwise")
    assert "SortMergeJoin(skew=true)" in final_plan(pairs)
    assert pairs.count() == N


def test_priority_netting_splits_a_hot_document(spark, hot_lines, small_partitions):
    netted = net_out(hot_lines, "priority")
    assert "SortMergeJoin(skew=true)" in final_plan(netted)
    assert netted.count() == N


def test_totals_need_no_pairs(spark, hot_lines, small_partitions):
    returns = hot_lines.filter("billing_type = 'ZRE'").selectExpr("assignment as billing_document", "billing_qty_in_sku as r")
    pairs = hot_lines.filter("billing_type = 'ZF2'").join(returns, "billing_document", "left")
    pairs = pairs.agg(F.count("*"), F.sum(F.expr("billing_qty_in_sku - coalesce(r, 0)"))).first()
    totals = pairwise_totals(hot_lines).agg(F.sum("n_rows"), F.sum("final_qty")).first()
    assert tuple(pairs) == tuple(totals)


def test_unmatched_returns_of_a_hot_document(spark, hot_lines, small_partitions):
    orphans = hot_lines.withColumn("billing_type", F.lit("ZRE")).withColumn("assignment", F.col("billing_document"))
    valid = hot_lines.filter("billing_document <> 7").limit(0).unionByName(hot_lines.filter("item = 1"))
    frame = unmatched_returns(orphans.unionByName(valid))
    assert "SortMergeJoin(skew=true)" in final_plan(frame)
    assert frame.count() == N + 300 - 1


def test_merge_splits_a_hot_key(spark, hot_lines, small_partitions):
    target = hot_lines.filter("billing_type = 'ZF2'").withColumn(
        "item", F.when(F.col("billing_document") == 7, 1).otherwise(F.col("item"))
    )
    feed = (
        target.dropDuplicates(["billing_document", "item"])
        .withColumn("billing_qty_in_sku", F.lit(11).cast("bigint"))
        .withColumns({"_action": F.lit("INSERT"), "_is_update": F.lit(True), "_seq": F.lit(1).cast("bigint")})
    )
    merged = merge_cdc(target, feed)
    assert "SortMergeJoin(skew=true)" in final_plan(merged)
    assert merged.agg(F.count("*"), F.sum("billing_qty_in_sku")).first() == (N, N * 11)


def test_update_from_splits_a_hot_key(spark, hot_lines, small_partitions):
    sales = hot_lines.filter("billing_type = 'ZF2'").withColumn("final_qty", F.lit(None).cast("bigint"))
    source = sales.select("billing_document").distinct().withColumn("final_qty", F.lit(3).cast("bigint"))
    updated = update_from(sales, source, ["billing_document"], {"final_qty": "final_qty"})
    assert "SortMergeJoin(skew=true)" in final_plan(updated)
    assert updated.agg(F.count("*"), F.sum("final_qty")).first() == (N, 3 * N)


def test_joins_equal_the_plain_ones(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    one = spark.createDataFrame([(1, 10), (None, 13)], "q int, w int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        kept = ["k", "v"] if how in ("left_semi", "left_anti") else ["k", "v", "w"]
        want = sorted(left.join(one, F.expr("k = q"), how).select(*kept).collect(), key=str)
        assert sorted(attach(left, one, {"k": "q"}, how).collect(), key=str) == want

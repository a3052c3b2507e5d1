from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgermill.functions.rules import clean
from ledgermill.operators import star, views


def test_product_is_described_by_its_latest_line(lines):
    silver = clean(
        lines(
            {"material": "m", "item_description": "old layer", "billing_date": date(2024, 1, 1)},
            {"material": "m", "item_description": "z broiler", "billing_date": date(2025, 1, 1)},
            {"material": "m", "item_description": "a fish", "billing_date": date(2025, 1, 1)},
            {"material": "n", "item_description": "undated", "billing_date": None},
            {"material": "n", "item_description": "dated", "billing_date": date(2020, 1, 1)},
            {"material": None, "item_description": "x"},
        )
    )
    got = {row.material: (row.item_description, row.product_category) for row in star.dim_product(silver).collect()}
    assert got == {"m": ("a fish", "Fish Feed"), "n": ("dated", "Other")}


def test_upsert_keeps_creation_and_stamps_updates(spark, lines):
    silver = clean(lines({"material": "m", "item_description": "new"}, {"material": "k", "item_description": "k"}))
    dim = star.dim_product(clean(lines({"material": "m", "item_description": "old"}, {"material": "q"}))).selectExpr(
        "*", "timestamp_ntz'2020-01-01' as created_at", "cast(null as timestamp_ntz) as updated_at"
    )
    now = F.lit("2025-01-01").cast("timestamp")
    got = {row.material: row for row in star.dim_product(silver, dim, now).collect()}
    assert (got["m"].item_description, got["m"].created_at.year, got["m"].updated_at.year) == ("new", 2020, 2025)
    assert (got["k"].created_at.year, got["k"].updated_at) == (2025, None)
    assert (got["q"].created_at.year, got["q"].updated_at) == (2020, None)


def test_insert_only_dimensions(lines):
    silver = clean(lines((1, 1, "ZF2", 1), (2, 1, None, 1), (3, 1, "XX", 1, {"billing_date": None})))
    types = star.dim_billing_type(silver)
    assert {tuple(row) for row in types.collect()} == {("ZF2", "Sales Invoice"), ("XX", "Other")}
    renamed = types.filter("billing_type = 'ZF2'").withColumn("billing_type_desc", F.lit("kept"))
    assert {tuple(row) for row in star.dim_billing_type(silver, renamed).collect()} == {("ZF2", "kept"), ("XX", "Other")}
    days = star.dim_date(silver)
    day = days.first()
    assert days.count() == 1
    assert (day.year, day.quarter, day.month, day.month_name, day.week, day.day, day.day_name, day.year_month) == (
        1996, 1, 3, "Mar", 11, 14, "Thu", "1996-03",
    )


def test_fact_variants(lines):
    stage = lines((1, 10, "ZF2", 5), (1, 10, "ZF2", 6), (2, 10, "ZRE", 5), (None, 10, "ZF2", 5))
    agg = lines((1, 10, "ZF2", 5), (1, 10, "ZF2", 5)).withColumn("final_qty", F.lit(4).cast("bigint"))
    fact = star.fact_left_enrich(stage, agg)
    # One row per staged line; several net rows of a line are summed.
    assert [r.final_qty for r in fact.filter("final_qty is not null").collect()] == [8, 8]
    assert views.null_count(fact).first() == (3, 1)
    rows = fact.filter("billing_document = 1")
    loaded = star.append_once(rows.withColumn("batch_id", F.lit(1001).cast("bigint")), rows, 1002)
    assert star.append_once(loaded, rows, 1002).count() == 4


def test_key_checks(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "material string")
    dim = spark.createDataFrame([("b",)], "material string")
    assert [tuple(row) for row in star.fk_orphans(fact, dim, "material").collect()] == [("a", 2)]
    assert [tuple(row) for row in star.pk_duplicates(fact, ["material"]).collect()] == [("a", 2)]


def test_sketches(spark):
    frame = spark.range(20000).selectExpr("id % 5000 as k", "if(id % 3 = 0, 1, id) as hot", "id % 4 as g")
    assert abs(views.approx_distinct(frame, "k").first().n - 5000) < 500
    merged = views.merged_distinct(views.distinct_sketches(frame, "g", "k")).first().n
    assert abs(merged - 5000) < 500
    assert views.approx_percentile(frame, "k", 0.7).first().value in range(3480, 3520)
    exact = views.top_k(frame, "hot", 2).collect()
    assert tuple(exact[0]) == (1, 6668) and views.top_k(frame, "hot", 1, exact=False).first()[0] == 1


def test_unknown_quantities_sort_last(spark):
    frame = spark.createDataFrame([(1, 1, None), (2, 1, 5), (3, 1, -5)], "billing_document int, item int, final_qty int")
    assert [row.final_qty for row in views.by_final_qty(frame).collect()] == [-5, 5, None]


def test_every_row_has_its_place_by_net_quantity(spark):
    rows = [(n, 1, None if n % 5 == 0 else n % 7 - 3) for n in range(300)]
    frame = spark.createDataFrame(rows, "billing_document bigint, item bigint, final_qty bigint").repartition(7)
    got = {r.billing_document: r.place for r in views.ranked_by_final_qty(frame).collect()}
    order = sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[0]))
    assert got == {doc: place for place, (doc, _, _) in enumerate(order, 1)}

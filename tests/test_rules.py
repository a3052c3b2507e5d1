from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgermill.functions.rules import categorize, clean, describe, final_amount


def test_category_takes_the_first_rule_that_matches(spark):
    texts = {
        "broiler pellets": "Broiler Feed",
        "broiler and layer": "Broiler Feed",
        "Layer mash": "Layer Feed",
        "calf starter": "Cattle Feed",
        "CATTLE 20": "Cattle Feed",
        "pig with deshi": "Pig Feed",
        "plain mash": "Other",
        None: "Other",
    }
    frame = spark.createDataFrame([(text,) for text in texts], "t string")
    got = {row.t: row.c for row in frame.select("t", categorize(F.col("t")).alias("c")).collect()}
    assert got == texts


def test_quality_flag_names_the_first_defect(lines):
    rows = lines(
        (None, 1, "ZF2", -1, {"billing_date": None}),
        (2, 1, "ZF2", -1, {"billing_date": None}),
        (3, 1, "ZF2", -1, {"material": None}),
        (4, 1, "ZF2", None),
        (5, 1, "ZF2", 1, {"material": None}),
        (6, 1, "ZF2", 0),
    )
    flags = {row.billing_document: row.data_quality_flag for row in clean(rows).collect()}
    assert flags == {
        None: "MISSING_DOC_ID",
        2: "INVALID_DATE",
        3: "INVALID_QUANTITY",
        4: "INVALID_QUANTITY",
        5: "MISSING_MATERIAL",
        6: "VALID",
    }
    months = {row.year_month for row in clean(rows).filter("billing_date is not null").collect()}
    assert months == {"1996-03"}


def test_final_amount(spark):
    frame = spark.createDataFrame(
        [(390, 10, 390), (0, 400, 400), (0, 0, 0), (-5, 9, -5), (7, 0, 7), (None, 3, 0), (3, None, 0)],
        "f bigint, r bigint, want bigint",
    )
    assert frame.filter(final_amount(F.col("f"), F.col("r")) != F.col("want")).count() == 0
    assert frame.filter(final_amount(F.col("f"), F.col("r")).isNull()).count() == 0


def test_describe(spark):
    frame = spark.createDataFrame([("ZF2",), ("S1",), ("XX",), (None,)], "t string")
    got = {row.t: row.d for row in frame.select("t", describe(F.col("t")).alias("d")).collect()}
    assert got == {"ZF2": "Sales Invoice", "S1": "Sales Adjustment", "XX": "Other", None: "Other"}


def test_literal_dates_stay_dates(lines):
    assert lines((1, 1, "ZF2", 1)).first().billing_date == date(1996, 3, 14)

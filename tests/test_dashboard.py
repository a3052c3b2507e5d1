from __future__ import annotations

import pytest

from ledgermill.operators import dashboard as d

SCHEMA = (
    "billing_document bigint, item bigint, year_month string, billing_type_desc string, product_category string, "
    "material_group string, billing_qty_in_sku bigint, return_qty bigint, final_qty bigint, t_final_amount bigint"
)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [
            (1, 10, "2025-01", "Sales Invoice", "Fish Feed", "A.1", 100, 10, 90, 90),
            (1, 20, "2025-02", "Sales Invoice", "Pig Feed", "B", 50, 0, 50, 50),
            (2, 10, "2025-03", "Export Sales", "Fish Feed", "A.1", 50, 40, 10, 10),
            (3, 10, "2025-04", "Sales Invoice", None, None, 0, 0, 0, 0),
        ],
        SCHEMA,
    )


def test_filter_semantics(rows):
    assert d.dash_filter(rows).count() == 4
    assert d.dash_filter(rows, months=[]).count() == 0
    assert d.dash_filter(rows, categories=["Fish Feed"], billing_types=["Sales Invoice"]).count() == 1
    assert d.dash_filter(rows, months=["2025-01", "2025-03"], groups=["A.1"]).count() == 2


def test_months(rows):
    assert [row[0] for row in d.options(rows, "year_month").collect()] == ["2025-01", "2025-02", "2025-03", "2025-04"]
    assert {row.year_month for row in d.in_last_months(rows).collect()} == {"2025-02", "2025-03", "2025-04"}


def test_kpis(rows):
    assert tuple(d.kpis(rows).first()) == (3, 200, 50, 150, 25.0)
    assert tuple(d.kpis(rows.limit(0)).first()) == (0, 0, 0, 0, 0.0)


def test_groupings_skip_unknown_keys(rows):
    assert [tuple(r) for r in d.category_sales(rows).collect()] == [("Pig Feed", 50, 1), ("Fish Feed", 100, 2)]
    assert [r.material_group for r in d.material_group_sales(rows).collect()] == ["A.1", "B"]
    assert [tuple(r) for r in d.monthly_sales(rows).collect()][0] == ("2025-01", 100, 10, 90, 1)


def test_share(spark):
    view = spark.createDataFrame([("a", 20), ("b", 10), ("a", 10)], "billing_type_desc string, total_final_qty bigint")
    assert {tuple(r) for r in d.share(view, "billing_type_desc", "total_final_qty").collect()} == {
        ("a", 30, 0.75), ("b", 10, 0.25),
    }


def test_search(rows):
    assert d.search_rows(rows, "").count() == 4
    assert d.search_rows(rows, "FISH").count() == 2
    assert d.search_rows(rows, "a.1").count() == 2
    assert d.search_rows(rows, "A.1", regex=False).count() == 2
    assert d.search_rows(rows, "202[56]-0(1|2)").count() == 2
    assert d.search_rows(rows, "none").count() == 0


def test_detail(rows):
    assert d.detail_rows(rows, None).count() == 4
    assert [r.item for r in d.detail_rows(rows, 2).collect()] == [10, 20]
    assert tuple(d.detail_counts(rows, "fish", 1).first()) == (1, 4, 2)
    assert tuple(d.detail_counts(rows, n=None).first()) == (4, 4, 2)


def test_trend(spark):
    by_date = spark.createDataFrame(
        [("2025-01-02", "2025-01", 5), ("2025-02-01", "2025-02", 6)],
        "date_key string, year_month string, total_final_qty bigint",
    )
    assert d.sales_trend(by_date).count() == 2
    assert d.sales_trend(by_date, []).count() == 2
    assert [r.total_final_qty for r in d.sales_trend(by_date, ["2025-02"]).collect()] == [6]
    assert d.sales_trend(by_date, by_date.select("year_month").limit(0)).count() == 0

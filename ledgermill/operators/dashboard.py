"""Dashboard figures over the rows of ``views.sales_dashboard``. All stay on the cluster."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dash_filter(
    dash: DataFrame,
    months: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    billing_types: Sequence[str] | None = None,
    groups: Sequence[str] | None = None,
) -> DataFrame:
    """Rows within all four selections; None selects everything, an empty list nothing."""
    selections = {
        "year_month": months,
        "product_category": categories,
        "billing_type_desc": billing_types,
        "material_group": groups,
    }
    for column, wanted in selections.items():
        if wanted is not None:
            dash = dash.filter(F.col(column).isin(*wanted) if wanted else F.lit(False))
    return dash


def options(dash: DataFrame, column: str) -> DataFrame:
    """Values to choose from, sorted."""
    return dash.select(column).distinct().orderBy(column)


def last_months(dash: DataFrame, n: int = 3) -> DataFrame:
    """The n latest months that occur."""
    return dash.select("year_month").distinct().orderBy(F.col("year_month").desc()).limit(n)


def in_last_months(dash: DataFrame, n: int = 3) -> DataFrame:
    """Rows of the n latest months; the list of months (n rows) never leaves the cluster."""
    return dash.join(last_months(dash, n), "year_month", "left_semi").select(*dash.columns)


def kpis(dash: DataFrame) -> DataFrame:
    """Documents, billed, returned and net quantity, and the return rate in percent."""
    zero = F.lit(0).cast("bigint")
    totals = dash.agg(
        F.count_distinct("billing_document").alias("total_documents"),
        F.coalesce(F.sum("billing_qty_in_sku"), zero).alias("total_qty"),
        F.coalesce(F.sum("return_qty"), zero).alias("total_returns"),
        F.coalesce(F.sum("final_qty"), zero).alias("final_qty"),
    )
    billed = F.col("total_qty").cast("double")
    rate = F.when(F.col("total_qty") > 0, F.col("total_returns").cast("double") / billed * 100).otherwise(0.0)
    return totals.withColumn("return_rate_pct", rate)


def sales_trend(by_date: DataFrame, months: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Net quantity per day, of the chosen months if any are chosen."""
    if isinstance(months, DataFrame):
        by_date = by_date.join(months.select("year_month"), "year_month", "left_semi")
    elif months:
        by_date = by_date.filter(F.col("year_month").isin(*months))
    return by_date.select("date_key", "total_final_qty").orderBy("date_key")


def share(view: DataFrame, key: str, value: str) -> DataFrame:
    """Value of each key, summed over its rows, and its part of the whole; the whole is a scalar subquery."""
    whole = view.agg(F.sum(value)).scalar().cast("double")
    part = F.when(whole != 0, F.col("total_qty").cast("double") / whole)
    return view.groupBy(key).agg(F.sum(value).alias("total_qty")).withColumn("share", part)


def _by(dash: DataFrame, key: str, *totals: Column) -> DataFrame:
    return dash.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *totals, F.count_distinct("billing_document").alias("total_docs")
    )


def category_sales(dash: DataFrame) -> DataFrame:
    """Net quantity and documents per product category, smallest first."""
    rows = _by(dash, "product_category", F.sum("final_qty").alias("total_qty"))
    return rows.orderBy("total_qty", "product_category")


def monthly_sales(dash: DataFrame) -> DataFrame:
    """Billed, returned and net quantity and documents per month."""
    rows = _by(
        dash,
        "year_month",
        F.sum("billing_qty_in_sku").alias("billing_qty"),
        F.sum("return_qty").alias("returns"),
        F.sum("final_qty").alias("final_qty"),
    )
    return rows.withColumnRenamed("total_docs", "documents").orderBy("year_month")


def material_group_sales(dash: DataFrame) -> DataFrame:
    """Net quantity and documents per material group, largest first."""
    rows = _by(dash, "material_group", F.sum("final_qty").alias("total_qty"))
    return rows.orderBy(F.col("total_qty").desc(), F.col("material_group").asc())


def matches(dash: DataFrame, term: str, regex: bool = True) -> Column:
    """Whether any column, as text, contains the term in any case; NULL contains nothing."""
    if regex:
        tests = [F.col(name).cast("string").rlike(f"(?i){term}") for name in dash.columns]
    else:
        tests = [F.lower(F.col(name).cast("string")).contains(term.lower()) for name in dash.columns]
    return reduce(or_, (F.coalesce(test, F.lit(False)) for test in tests), F.lit(False))


def search_rows(dash: DataFrame, term: str, regex: bool = True) -> DataFrame:
    """Rows in which some column contains the term; an empty term keeps all."""
    return dash.filter(matches(dash, term, regex)) if term else dash


def detail_rows(dash: DataFrame, n: int | None = 25) -> DataFrame:
    """The first n rows by document and line, or all of them."""
    if n is None:
        return dash
    return dash.orderBy(*dash.columns).limit(n)


def detail_counts(dash: DataFrame, term: str = "", n: int | None = 25) -> DataFrame:
    """Rows shown, rows selected and material groups among them, in one pass."""
    hit = matches(dash, term) if term else F.lit(True)
    found = F.count_if(hit)
    shown = found if n is None else F.least(found, F.lit(n).cast("bigint"))
    return dash.agg(
        shown.alias("shown_records"),
        F.count("*").alias("total_records"),
        F.count_distinct("material_group").alias("unique_material_groups"),
    )

"""Rule columns: the rules are data, the functions fold them into one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill import fixed_values as fx


def first_match(rules: Iterable[tuple[Column, str]], default: str) -> Column:
    """Label of the first condition that holds, else the default."""
    chain = None
    for condition, label in rules:
        chain = F.when(condition, label) if chain is None else chain.when(condition, label)
    return F.lit(default) if chain is None else chain.otherwise(default)


def one_of(column: str, values: Iterable[str]) -> Column:
    """Membership in a short list, as equalities: unlike IN, Spark folds these into a CASE, so a
    union branch that can only produce other values disappears from the plan."""
    return reduce(or_, (F.col(column) == value for value in values), F.lit(False))


def categorize(
    text: Column,
    rules: Sequence[tuple[Sequence[str], str]] = tuple(fx.CATEGORY_RULES),
    default: str = fx.OTHER_CATEGORY,
) -> Column:
    """Category of a text by the first rule one of whose keywords occurs in it, in any case."""
    upper = F.upper(text)
    return first_match(
        ((reduce(or_, (upper.contains(word) for word in words)), label) for words, label in rules),
        default,
    )


def billing_quality_rules() -> list[tuple[Column, str]]:
    quantity = F.col("billing_qty_in_sku")
    return [
        (F.col("billing_document").isNull(), fx.MISSING_DOC_ID),
        (F.col("billing_date").isNull(), fx.INVALID_DATE),
        (quantity.isNull() | (quantity < 0), fx.INVALID_QUANTITY),
        (F.col("material").isNull(), fx.MISSING_MATERIAL),
    ]


def quality_flag(
    rules: Iterable[tuple[Column, str]] | None = None, default: str = fx.VALID
) -> Column:
    """Name of the first defect of a row."""
    return first_match(billing_quality_rules() if rules is None else rules, default)


def describe(
    code: Column,
    names: Mapping[str, str] = fx.BILLING_TYPE_NAMES,
    default: str = fx.OTHER_BILLING_TYPE,
) -> Column:
    """Readable name of a code."""
    return first_match(((code == key, name) for key, name in names.items()), default)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def final_amount(final_qty: Column, return_qty: Column) -> Column:
    """The net quantity, or the returned one when nothing is left; 0 when either is unknown."""
    amount = F.when(final_qty != 0, final_qty).when(final_qty == 0, return_qty)
    return F.coalesce(F.when(return_qty.isNotNull(), amount), F.lit(0).cast("bigint"))


def clean(lines: DataFrame) -> DataFrame:
    """Silver columns: the nine delivered ones plus category, month and quality flag."""
    return lines.withColumns(
        {
            "product_category": categorize(F.col("item_description")),
            "year_month": year_month(F.col("billing_date")),
            "data_quality_flag": quality_flag(),
        }
    )


def dq_summary(silver: DataFrame) -> DataFrame:
    """Rows per quality flag."""
    return silver.groupBy("data_quality_flag").agg(F.count("*").alias("record_count"))

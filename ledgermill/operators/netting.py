"""Netting invoices against the returns and adjustments assigned to them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import sub

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill import fixed_values as fx
from ledgermill.functions.rules import final_amount, one_of
from ledgermill.operators.joins import attach
from ledgermill.operators.marks import marks

_BY_LINE = {
    "billing_document": "assignment",
    "material": "material",
    "item_description": "item_description",
}
_BY_MATERIAL = {"billing_document": "assignment", "material": "material"}
# From so many returns on, invoices that none can point at are kept out of the join. Fewer are broadcast as they are.
MANY_RETURNS = 1_000_000
# The most bits marked (64 MB), above which more are joined in vain; and the fewest.
MOST_BITS = 1 << 29
_BITS = 32_768


def returns_agg(lines: DataFrame, return_types: Sequence[str] = fx.RETURN_TYPES) -> DataFrame:
    """Returned quantity per assigned document, material and description."""
    return (
        lines.filter(one_of("billing_type", return_types))
        .groupBy("assignment", "material", "item_description")
        .agg(F.sum("billing_qty_in_sku").alias("return_qty"))
    )


def net_out(
    silver: DataFrame,
    mode: str = "sum",
    invoice_types: Sequence[str] = fx.INVOICE_TYPES,
    return_types: Sequence[str] = fx.RETURN_TYPES,
    returns: DataFrame | None = None,
) -> DataFrame:
    """Invoice lines with what is left of them.

    ``sum``: valid invoices minus the sum of their returns, one row per invoice line.
    ``pairwise``: every invoice line, valid or not, minus all returns of it, with their number and
    their sums by type. One row per line: the pairs themselves would grow with the square of a key.
    ``priority``: distinct invoice lines, and lines any return points at, minus the returns of the
    first type in ``return_types`` that exists; the sums of every type are kept side by side.
    With ``sum``, ``returns`` may be given as a table of their own, whose size then decides whether invoices are shuffled.
    """
    if mode == "sum":
        return _net_by_sum(silver, invoice_types, return_types, silver if returns is None else returns)
    if mode == "pairwise":
        return _net_pairwise(silver, invoice_types, return_types)
    if mode == "priority":
        return _net_by_priority(silver, invoice_types, return_types)
    raise ValueError(f"unknown mode {mode!r}: use sum, pairwise or priority")


def _net_by_sum(silver: DataFrame, invoice_types: Sequence[str], return_types: Sequence[str], returns: DataFrame) -> DataFrame:
    invoices = silver.filter(
        one_of("billing_type", invoice_types) & (F.col("data_quality_flag") == fx.VALID)
    ).select(*fx.BILLING_COLUMNS)
    zero = F.lit(0).cast("bigint")
    named, alone = invoices, None
    # Only a table of its own is cheap to look at twice.
    if returns is not silver:
        named, alone = _named_or_not(invoices, returns.filter(one_of("billing_type", return_types)))
    netted = attach(named, returns_agg(returns, return_types), _BY_LINE)
    if alone is not None:
        netted = netted.unionByName(alone.withColumn("return_qty", zero))
    return_qty = F.coalesce("return_qty", zero)
    return (
        netted.withColumn("return_qty", return_qty)
        .withColumn("final_qty", F.col("billing_qty_in_sku") - F.col("return_qty"))
        .withColumn("t_final_amount", final_amount(F.col("final_qty"), F.col("return_qty")))
    )


def _named_or_not(invoices: DataFrame, returns: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Invoices that returns may point at, and those that none does, which then need no shuffle; ``None`` if returns are few.

    Hashes of what returns point at are marked and broadcast: one byte per return. An equal hash
    of another key does no harm, as the join compares the keys.
    """
    n_returns = returns.count()
    if n_returns < MANY_RETURNS:
        return invoices, None
    return marks(returns, [*_BY_LINE.values()], n_returns, MOST_BITS, MANY_RETURNS).split(invoices, [*_BY_LINE])


def _returns_by_type(lines: DataFrame, keys: Sequence[str], return_types: Sequence[str]) -> DataFrame:
    """Per key the number of returns and, for every type, whether there are any and their sum."""
    of_type = {code: F.col("billing_type") == code for code in return_types}
    named = F.col("billing_document").isNotNull()
    return (
        lines.filter(one_of("billing_type", return_types))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n_returns"),
            *(F.bool_or(test & named).alias(f"_has_{code.lower()}") for code, test in of_type.items()),
            *(F.sum(F.when(test, F.col("billing_qty_in_sku"))).alias(f"{code.lower()}_bq") for code, test in of_type.items()),
        )
    )


def _net_pairwise(lines: DataFrame, invoice_types: Sequence[str], return_types: Sequence[str]) -> DataFrame:
    invoices = lines.filter(one_of("billing_type", invoice_types)).select(*fx.BILLING_COLUMNS)
    returns = _returns_by_type(lines, ["assignment", "material", "item_description"], return_types)
    zero = F.lit(0).cast("bigint")
    sums = [f"{code.lower()}_bq" for code in return_types]
    final = reduce(sub, (F.coalesce(name, zero) for name in sums), F.col("billing_qty_in_sku"))
    return (
        attach(invoices, returns, _BY_LINE)
        .withColumn("n_returns", F.coalesce("n_returns", zero))
        .withColumn("final_qty", final)
        .select(*fx.BILLING_COLUMNS, "n_returns", *sums, "final_qty")
    )


def pairwise_totals(
    lines: DataFrame,
    invoice_types: Sequence[str] = fx.INVOICE_TYPES,
    return_types: Sequence[str] = fx.RETURN_TYPES,
) -> DataFrame:
    """What the pairs of invoice line and return of each (document, item) sum up to, without making them.

    An invoice line with n returns stands for n rows of quantity minus return, one without for
    itself; so count and sum of the returns are enough.
    """
    invoices = lines.filter(one_of("billing_type", invoice_types)).select(
        "billing_document", "item", "billing_qty_in_sku", "material", "item_description"
    )
    returns = (
        lines.filter(one_of("billing_type", return_types))
        .groupBy("assignment", "material", "item_description")
        .agg(F.count("*").alias("_returns"), F.sum("billing_qty_in_sku").alias("_returned"))
    )
    zero = F.lit(0).cast("bigint")
    rows = F.coalesce("_returns", F.lit(1).cast("bigint"))
    return (
        attach(invoices, returns, _BY_LINE)
        .withColumn("_final", F.col("billing_qty_in_sku") * rows - F.coalesce("_returned", zero))
        .groupBy("billing_document", "item")
        .agg(F.sum(rows).alias("n_rows"), F.sum("_final").alias("final_qty"))
    )


def _net_by_priority(lines: DataFrame, invoice_types: Sequence[str], return_types: Sequence[str]) -> DataFrame:
    lines = lines.select(*fx.BILLING_COLUMNS)
    is_invoice = F.coalesce(one_of("billing_type", invoice_types), F.lit(False))
    returns = _returns_by_type(lines, ["assignment", "material"], return_types)
    # One row per distinct line; of lines that are no invoices, those that some return points at.
    netted = attach(lines.distinct(), returns, _BY_MATERIAL).filter(is_invoice | F.col("n_returns").isNotNull())
    quantity = F.col("billing_qty_in_sku")
    left_over = None
    for code in return_types:
        found, rest = F.col(f"_has_{code.lower()}"), quantity - F.col(f"{code.lower()}_bq")
        left_over = F.when(found, rest) if left_over is None else left_over.when(found, rest)
    return netted.withColumn("final_quantity", left_over.otherwise(quantity)).select(
        *fx.BILLING_COLUMNS, *(f"{code.lower()}_bq" for code in return_types), "final_quantity"
    )


def unmatched_returns(
    silver: DataFrame,
    invoice_types: Sequence[str] = fx.INVOICE_TYPES,
    return_types: Sequence[str] = fx.RETURN_TYPES,
) -> DataFrame:
    """Returns that reduce no valid invoice line: those the netting leaves out."""
    invoice_keys = (
        silver.filter(
            one_of("billing_type", invoice_types) & (F.col("data_quality_flag") == fx.VALID)
        )
        .select("billing_document", "material", "item_description")
        .distinct()
    )
    by_line = {theirs: ours for ours, theirs in _BY_LINE.items()}
    return attach(
        silver.filter(one_of("billing_type", return_types)), invoice_keys, by_line, "left_anti"
    )


def affected_invoices(
    changes: DataFrame,
    silver: DataFrame,
    invoice_types: Sequence[str] = fx.INVOICE_TYPES,
    return_types: Sequence[str] = fx.RETURN_TYPES,
) -> DataFrame:
    """Keys of the invoice lines to net again: changed themselves, or hit by a changed return."""
    invoices = silver.filter(one_of("billing_type", invoice_types)).select(
        "billing_document", "item", "material", "item_description"
    )
    changed = changes.select("billing_document", "item").distinct()
    hits = (
        changes.filter(one_of("billing_type", return_types))
        .select("assignment", "material", "item_description")
        .distinct()
    )
    itself = attach(invoices, changed, {"billing_document": "billing_document", "item": "item"}, "left_semi")
    by_return = attach(invoices, hits, _BY_LINE, "left_semi")
    return (
        itself.select("billing_document", "item")
        .unionByName(by_return.select("billing_document", "item"))
        .distinct()
    )

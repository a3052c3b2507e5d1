"""Billing lines derived from the ``lineitem`` and ``part`` tables, for queries and tests.

Every value is computed from its own row, so the adapter needs no shuffle beyond the lookup of
the part, and a sales line and its return agree on document, material and description.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.rules import clean

# First word of a description by part number modulo 8.
WORDS = ["Broiler", "LAYER", "Cattle", "calf", "Fish", "Pig", "Deshi", "Misc"]
# A return document is numbered this much above its order.
RETURN_OFFSET = 80000000
MATERIAL_OFFSET = 34000000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def billing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sales row per order line and one return row per returned order line.

    The item number is made of the line's own part, quantity, discount, tax and line number.
    """
    words = ", ".join(f"'{word}'" for word in WORDS)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    # What needs no part is computed before the join, and a line's return is made after it, so that lines meet parts once.
    lines = (
        table(spark, sf_dir, "lineitem")
        .selectExpr(
            "l_orderkey",
            "l_partkey",
            "l_returnflag",
            "l_linestatus",
            "cast(l_quantity as bigint) as quantity",
            "case when l_returnflag = 'R' then cast(floor(l_quantity * l_discount * 10) as bigint) end as returned",
            "cast(l_shipdate as date) as day",
            """(((l_partkey * 100 + cast(l_quantity as bigint)) * 100
                 + cast(round(l_discount * 100) as bigint)) * 100
                 + cast(round(l_tax * 100) as bigint)) * 10 + l_linenumber as item""",
        )
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(
            "*",
            f"cast(l_partkey + {MATERIAL_OFFSET} as string) as part_number",
            f"concat_ws(' ', element_at(array({words}), cast(l_partkey % 8 + 1 as int)), p_name) as item_description",
            "explode(if(l_returnflag = 'R', array(false, true), array(false))) as back",
        )
    )
    return lines.selectExpr(
        f"if(back, l_orderkey + {RETURN_OFFSET}, l_orderkey) as billing_document",
        "item",
        """case when back then if(l_linestatus = 'F', 'ZRE', 'S1')
                when l_returnflag = 'A' and l_linestatus = 'O' then 'ZXP' else 'ZF2' end as billing_type""",
        "case when back or l_orderkey % 89 != 0 then day end as billing_date",
        "case when back then returned when l_orderkey % 83 = 0 then -quantity else quantity end as billing_qty_in_sku",
        "case when back or l_orderkey % 79 != 0 then part_number end as material",
        "item_description",
        "p_brand as material_group",
        "l_orderkey as assignment",
    )


def silver_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(billing_lines(spark, sf_dir))


def _last_digit() -> Column:
    return F.col("billing_document") % 10


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table before the change feed: documents ending in 3 are still missing."""
    return billing_lines(spark, sf_dir).filter(_last_digit() != 3)


def snapshot_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after deletes (1), updates (2) and inserts (3), without any merge."""
    quantity = F.col("billing_qty_in_sku")
    return (
        billing_lines(spark, sf_dir)
        .filter(_last_digit() != 1)
        .withColumn("billing_qty_in_sku", F.when(_last_digit() == 2, quantity + 1).otherwise(quantity))
    )


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes (1), update pairs (2), inserts (3) and re-delivered keys (4), by last digit."""
    lines = billing_lines(spark, sf_dir)
    digit = _last_digit()
    quantity = F.col("billing_qty_in_sku")
    old_images = lines.filter(digit.isin(1, 2)).withColumns(
        {"_action": F.lit("DELETE"), "_is_update": digit == 2, "_seq": F.lit(1).cast("bigint")}
    )
    new_images = lines.filter(digit.isin(2, 3, 4)).withColumns(
        {
            "billing_qty_in_sku": quantity + F.when(digit == 2, 1).when(digit == 4, 100).otherwise(0),
            "_action": F.lit("INSERT"),
            "_is_update": digit == 2,
            "_seq": F.lit(2).cast("bigint"),
        }
    )
    return old_images.unionByName(new_images)

"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected as often: its source's target over its source's size. The
expected copies are summed along the documents of a source, one random offset is added, and a document
is emitted once for each whole number that its own share of the sum crosses. Documents lie in order of
their size class, so that each class is met at its rate and the words taken come near the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.texts import n_words_of
from ledgermill.session import stored

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
# Hexadecimal digits of the digest that deals a source's documents out to groups.
GROUP_DIGITS = 3
_SOURCE = ("_source", "_no_source")


def _ranked_sources(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``_rank``, the place of each source by code point, null last, from 0.

    Ranks are made in ranges: the source table may be long too.
    """
    order = [F.col("_no_source"), F.col("_source")]
    ranged = stored(
        sizes.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "sources"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn("_rank", within).join(offsets, "_part").withColumn(
        "_rank", F.col("_rank") + F.col("_before")
    ).drop("_part", "_before")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``sizes`` (one row per source with ``source_size``) with each source's target.

    A target stops at ``most`` times the source's size; what is over is shared by weight among the
    others, until none is above. Only sums reach the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighed = stored(_ranked_sources(sizes).withColumn("_weight", weight), "weights")
    cap = F.col("source_size") * F.lit(most)
    total = (weighed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, n_capped = 0.0, -1
    while True:
        capped = cap <= F.col("_weight") * F.lit(level)
        held, open_weight, n = weighed.agg(
            F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("_weight"))), F.count_if(capped)
        ).first()
        if n == n_capped or not open_weight:
            break
        n_capped, level = n, (total - (held or 0.0)) / open_weight
    capped = cap <= F.col("_weight") * F.lit(level)
    return weighed.withColumn("target", F.when(capped, cap).otherwise(F.col("_weight") * F.lit(level)))


def _offset_of_source() -> Column:
    """The random offset: the same for a source in every run, between 0 and 1."""
    digest = F.md5(F.concat_ws(":", F.col("_no_source").cast("string"), F.col("_source")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def copies(
    docs: DataFrame, kept: Sequence[str], weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """_doc (columns ``kept`` of ``docs``), _size, _source_size, _target (its source's) and _copies, how often the mix
    has the row."""
    # The caller's columns go into one, so that none can be taken for a helper.
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in kept)).alias("_doc"),
        F.col("doc_id").alias("_id"),
        n_words_of().alias("_size"),
        F.coalesce(F.col("source"), F.lit("")).alias("_source"),
        F.col("source").isNull().cast("int").alias("_no_source"),
        # Made before the shuffle, so that a text that is not wanted itself does not move.
        F.xxhash64("text").alias("_tie"),
    )
    # Rows without doc_id are dealt out by their texts.
    dealt = F.coalesce(F.col("_id").cast("string"), F.concat(F.lit("text:"), F.col("_tie").cast("string")))
    rows = rows.withColumns(
        {"_group": F.substring(F.md5(dealt), 1, GROUP_DIGITS), "_class": F.length(F.bin("_size"))}
    )
    group = [*_SOURCE, "_class", "_group"]
    # The narrow counts; documents themselves move once, to their group.
    counts = stored(
        rows.groupBy(*group).agg(F.count("*").alias("_n"), F.sum("_size").alias("_words")), "groups"
    )
    targets = source_targets(
        counts.groupBy(*_SOURCE).agg(F.sum("_words").alias("source_size")), weights, share, most
    )
    before = Window.partitionBy(*_SOURCE).orderBy("_class", "_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .join(targets.select(*_SOURCE, "source_size", "target"), list(_SOURCE))
        .select(
            *group,
            "_before",
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_rate"),
            _offset_of_source().alias("_offset"),
        )
    )
    within = Window.partitionBy(*group).orderBy("_size", "_id", "_tie")
    rank = F.col("_before") + F.row_number().over(within) - 1

    def up_to(n: Column) -> Column:
        return F.floor(n * F.col("_rate") + F.col("_offset"))

    placed = rows.join(offsets, group).withColumn("_rank", rank)
    return placed.withColumn("_copies", up_to(F.col("_rank") + 1) - up_to(F.col("_rank"))).select(
        "_doc", "_size", "_source_size", "_target", "_copies"
    )


def mix_report(docs: DataFrame, **targets) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``, ``source``): doc_id, size, source_size, target, taken.

    taken is the words that the mix takes from the row, copies counted.

    Null texts have size 0 and give no words; a null source is a source of its own, the last. A source
    without words has target 0. Repeated rows count and are drawn each on their own; null doc_ids stay
    null; an empty table gives no rows. Other columns are not looked at.
    """
    drawn = copies(docs, ["doc_id"], **targets)
    return drawn.select(
        "_doc.doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def mix(docs: DataFrame, **targets) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is drawn, with the columns of ``docs``.

    Null and empty texts have size 0 and come at most as often as the others; a null source is a source of its own;
    repeated rows are drawn each; an empty table stays empty; texts of any length count whole. All columns are kept as they
    are, whatever their names.
    """
    drawn = copies(docs, docs.columns, **targets)
    # At most ``most`` copies, rounded up: a handful.
    each = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return drawn.filter("_copies > 0").withColumn("_copy", each).select("_doc.*")

"""Equi-joins that keep working when one key holds a large part of all rows.

Adaptive execution splits a skewed partition of a join between several tasks, but only if each
side of the join reads straight from a shuffle. An aggregate grouped by the join keys does not:
its output already has the right partitioning, so no shuffle stands between it and the join, and
a hot key would stay with one task. The joins below compare a hash of the keys and the keys packed
into a struct. Neither is a grouping key, so Spark shuffles the aggregated side once more (after
aggregation, so it is small) and the big side can be split. The hash also keeps sorting cheap.

Equality never matches NULL keys here: rows of the other side with one are left out beforehand.
Being packed, the keys get no inferred NOT NULL filters either, which would be pushed into one
reading of a shuffle and not into the other and so make Spark compute it twice.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PREFIX = "_other_"


def _sides(rows: DataFrame, other: DataFrame, on: Mapping[str, str]) -> tuple[DataFrame, DataFrame, Column]:
    names = {theirs: _PREFIX + theirs for theirs in on.values()}
    right = other.filter(reduce(and_, (F.col(name).isNotNull() for name in names))).select(
        *(F.col(name).alias(names.get(name, name)) for name in other.columns)
    )
    keys = F.struct(*(F.col(ours).alias(ours) for ours in on))
    other_keys = F.struct(*(F.col(names[theirs]).alias(ours) for ours, theirs in on.items()))
    # The hash is made anew where it is needed: as a column it would be eight bytes of every shuffled row.
    return rows, right, (F.xxhash64(*on) == F.xxhash64(*names.values())) & (keys == other_keys)


def _tidy(joined: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return joined.drop(*(_PREFIX + theirs for theirs in on.values()))


def attach(rows: DataFrame, lookup: DataFrame, on: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join rows to a lookup with at most one row per key.

    ``on`` maps columns of ``rows`` to columns of ``lookup``; the lookup's key columns are not
    kept. ``how`` is one of left, inner, left_semi, left_anti, for all of which Spark can split
    the rows of a hot key.
    """
    left, right, equal = _sides(rows, lookup, on)
    return _tidy(left.join(right, equal, how), on)

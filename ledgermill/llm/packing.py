"""Packing documents into token sequences by minimum bin slack.

Documents are cut into full windows and one rest. How many rests there are of each length is all that
packing depends on, and there are fewer lengths than a window has tokens, so the plan is made from
these counts alone: the longest length left is set, a subset-sum over bitsets finds the multiset of
remaining lengths that comes closest to filling the window, backtracking gives its counts, and the
pattern is used as often as the counts allow. The plan has a few thousand patterns at any corpus size.
Rests are then numbered within their length and each number looked up in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.texts import text_of
from ledgermill.llm.tokenizing import encoder, shared_tokenizer
from ledgermill.session import stored

PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
# Pieces that are numbered together, about; a length with more is dealt out to more groups.
GROUP_ROWS = 1_000
# Pieces of text a worker remembers the ids of; fewer where it is to forget them, among other work.
REMEMBERED, REMEMBERED_BRIEFLY = 400_000, 150_000
# Texts that are encoded together.
TEXTS = 512


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts`` of each, whose sum comes closest to ``room`` from below.

    Bit s of a bitset says that sum s can be reached. Counts are split into powers of two, so a length
    costs a few shifts; the search ends as soon as ``room`` itself is reached.
    """
    mask, reached = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    lengths = sorted(counts)
    for length in reversed(lengths[: bisect_left(lengths, room + 1)]):
        left, times = min(counts[length], room // length), 1
        while left and not reached >> room & 1:
            times = min(times, left)
            steps.append((length, times, reached))
            reached |= reached << length * times & mask
            left -= times
            times *= 2
        if reached >> room & 1:
            break
    total, used = reached.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + times
            total -= length * times
    return used


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, lengths in each) until every counted length has its place."""
    left, plan = {n: c for n, c in counts.items() if c}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        used = fullest({n: c for n, c in left.items() if c}, capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        bins = min(left[n] // k for n, k in used.items())
        plan.append((bins, used))
        for n, k in used.items():
            left[n] -= bins * k
            if not left[n]:
                del left[n]
    return plan


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, forget: bool = False) -> DataFrame:
    """Each document's ids with ``end_id`` behind them, cut into full windows and a rest.

    A worker keeps what its encoder has learnt for the next task, unless it is to ``forget`` it.
    """
    spark = docs.sparkSession
    content, version = shared_tokenizer(spark, tokenizer_path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(content.value, version, REMEMBERED_BRIEFLY if forget else REMEMBERED)
        for batch in (whole.slice(at, TEXTS) for whole in batches for at in range(0, whole.num_rows, TEXTS)):
            rows: list[tuple] = []
            arrays = known.ids(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), arrays, strict=True):
                ids = np.append(ids, end_id).astype("<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        if forget:
            known.forget()

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(cut, PIECE_SCHEMA)


def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """Give every piece its sequence_id, offset and padded_to (the length its sequence is padded to).

    ``cut`` should be a stored table: it is read three times.
    """
    counts = length_counts(cut)
    return placed(cut, counts, plan_bins({n: c for n, c in counts.items() if n < capacity}, capacity), capacity)


def length_counts(cut: DataFrame) -> dict[int, int]:
    """How many pieces there are of each length: at most as many numbers as the capacity, whatever the corpus."""
    return {row.length: row.n for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}


def placed(cut: DataFrame, counts: dict[int, int], plan: list[tuple[int, dict[int, int]]], capacity: int) -> DataFrame:
    """Places of all pieces under a plan for those shorter than ``capacity``; a full piece is a sequence of its own.

    ``counts`` are those of ``cut``, and ``plan`` has (number of bins, lengths in each) for all shorter lengths.
    """
    spark = cut.sparkSession
    # At most ``capacity`` rows; so is the table made of them that is broadcast below.
    groups = spark.createDataFrame([(n, c // GROUP_ROWS + 1) for n, c in counts.items()], "length bigint, _groups bigint")
    places: dict[int, list[tuple[int, int, int, int, int]]] = {}
    taken = dict.fromkeys(counts, 0)
    first_bin = 0
    for bins, used in plan:
        total = sum(n * k for n, k in used.items())
        padded = total if total & (total - 1) == 0 else capacity
        offset = 0
        for n, k in sorted(used.items(), reverse=True):
            places.setdefault(n, []).append((taken[n], k, first_bin, offset, padded))
            taken[n] += bins * k
            offset += n * k
        first_bin += bins
    shared = spark.sparkContext.broadcast({n: np.array(rows, np.int64) for n, rows in places.items()})

    # Rank within a length: rank within a group of it, plus the pieces in the groups before.
    mark = F.xxhash64("doc_id", "start", "ids_crc32")
    grouped = cut.join(F.broadcast(groups), "length").withColumn("_group", F.pmod(mark, "_groups")).drop("_groups")
    # Full pieces need no place in the plan, so their numbers may have gaps: a group's begin at a multiple of 2^32.
    full = F.col("length") == capacity
    sizes = grouped.filter(~full).groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_group").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        grouped.withColumn("_rank", F.row_number().over(within) - 1)
        .join(offsets, ["length", "_group"], "left")
        .withColumn("_rank", F.col("_rank") + F.when(full, F.shiftleft(F.col("_group"), 32)).otherwise(F.col("_before")))
        .drop("_group", "_before")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            out = np.zeros((3, len(lengths)), np.int64)
            for n in np.unique(lengths):
                own = np.flatnonzero(lengths == n)
                if n == capacity:
                    out[0, own], out[2, own] = first_bin + ranks[own], capacity
                    continue
                begin, each, first, at, padded = shared.value[int(n)].T
                slot = np.searchsorted(begin, ranks[own], "right") - 1
                inside = ranks[own] - begin[slot]
                out[0, own] = first[slot] + inside // each[slot]
                out[1, own] = at[slot] + inside % each[slot] * n
                out[2, own] = padded[slot]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *map(pa.array, out)], [*names, "sequence_id", "offset", "padded_to"]
            )

    return ranked.mapInArrow(place, f"{PIECE_SCHEMA}, sequence_id bigint, offset bigint, padded_to bigint")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, forget: bool = False
) -> DataFrame:
    """Pack ``docs`` (``doc_id``, ``text``) into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, start (its document's ids before it), length, ids_crc32, doc_tokens,
    sequence_id, offset and padded_to. A sequence is padded to ``capacity`` unless its length is a power
    of two already. ``forget`` frees what the workers' encoders have learnt, for a job that goes on with
    other work.

    Null and empty texts are the end id alone. Null doc_ids stay null; repeated rows are packed each; an
    empty table gives no rows; texts of any length are cut whole. Other columns are not looked at.
    """
    return pack(stored(pieces(docs, tokenizer_path, capacity, end_id, forget), "pieces"), capacity)

"""Runs of repeated words, found by catching squares online.

The words of a text come one after the other. Whenever a block of 2^j words is complete, a catcher is set
over it: while the words behind it arrive, the catcher compares the latest 2^j of them with its block. Where
they are equal, p words on, the block and its return are part of a square of period p if the words around
them go on agreeing. A catcher answers for the periods 2^(j+1) - 1 to 2^(j+2) - 2 and is taken off after
them, so each word that comes is compared by two catchers of each size; and since the first half of a square
of such a period holds a whole block, none is missed. Catches of one period over neighbouring blocks belong
to one run; its ends are found by comparing words.

A word's comparisons depend on earlier words only, so they are made size by size for all words of many texts
at once, blocks being compared by hashes of 64 bits. A run is checked word by word before it counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.texts import WORD, text_of

LEAST_LENGTH = 12
# Words that are looked at together; texts are not split, so a longer one is looked at alone.
BATCH_WORDS = 1 << 17
# Words whose comparisons are made at once.
STEP_WORDS = 1 << 18

RUNS_SCHEMA = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed_text string"


def _mixed(marks: np.ndarray) -> np.ndarray:
    marks = (marks ^ marks >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    marks = (marks ^ marks >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return marks ^ marks >> np.uint64(31)


def _catches(marks: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a block's catcher meets its block again: (period, start of the block), in that order.

    ``marks`` has the hash of the 2^level words from each place on.
    """
    size, periods, starts = 1 << level, [], []
    nearest = 2 * size - 1
    for at in range(nearest, len(marks), STEP_WORDS):
        came = np.arange(at, min(at + STEP_WORDS, len(marks)))
        latest = marks[at : at + STEP_WORDS]
        block = (came - nearest) & -size
        for _ in range(2):
            hit = np.flatnonzero((latest == marks[block]) & (block >= 0))
            starts.append(block[hit])
            periods.append(came[hit] - block[hit])
            block = block - size
    start, period = np.concatenate(starts), np.concatenate(periods)
    order = np.lexsort((start, period))
    return period[order], start[order]


def _agreeing(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How many places from ``at`` on, forward or backward, agree with the place ``period`` further on."""
    n, done, width = len(words), 0, 16
    while True:
        if step > 0:
            low, high = at + done, min(at + done + width, n - period)
        else:
            low, high = max(at - done - width + 1, 0), at - done + 1
        if low >= high:
            return done
        same = words[low:high] == words[low + period : high + period]
        if step < 0:
            same = same[::-1]
        if not same.all():
            return done + int(same.argmin())
        done += high - low
        width *= 2


def runs_of(words: np.ndarray, longest: int, least: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of at least ``least`` words, by start and period.

    ``words`` are numbers for the words of texts in a row, none longer than ``longest``, with a number that
    comes nowhere else behind each.
    """
    marks = _mixed(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    found: dict[tuple[int, int], int] = {}
    by_period: dict[int, list[tuple[int, int]]] = {}
    level = 0
    # The smallest period of this size, twice, has to fit into a text.
    while 2 * ((2 << level) - 1) <= longest and len(marks):
        size = 1 << level
        periods, starts = _catches(marks, level)
        # Catches of one period on neighbouring blocks are one chain.
        breaks = np.flatnonzero((np.diff(periods) != 0) | (np.diff(starts) != size)) + 1
        firsts, ends = np.append(0, breaks), np.append(breaks, len(periods))
        if len(periods):
            # So many blocks at least lie within the part of a run that agrees with what is a period further on.
            needed = (np.maximum(periods[firsts], least - periods[firsts]) + 1) // size - 1
            long_enough = ends - firsts >= needed
            firsts, ends = firsts[long_enough], ends[long_enough]
        else:
            firsts, ends = firsts[:0], ends[:0]
        for first, end in zip(firsts.tolist(), ends.tolist(), strict=True):
            p, low, high = int(periods[first]), int(starts[first]), int(starts[end - 1]) + size
            # Within a run of a period that divides this one there is nothing new, nor in the same run again.
            if _inside(by_period, p, low, high + p):
                continue
            if not np.array_equal(words[low:high], words[low + p : high + p]):
                continue  # two blocks of one hash
            low -= _agreeing(words, low - 1, p, -1)
            high += _agreeing(words, high, p, 1) + p
            if high - low >= max(least, 2 * p) and (low, high) not in found:
                found[low, high] = p
                by_period.setdefault(p, []).append((low, high))
        marks = _mixed(marks[:-size] * np.uint64(0x9FB21C651E98DF25) + (marks[size:] << np.uint64(17) | marks[size:] >> np.uint64(47)))
        level += 1
    return sorted((low, high, p) for (low, high), p in found.items())


def _inside(by_period: dict[int, list[tuple[int, int]]], period: int, low: int, high: int) -> bool:
    for p, runs in by_period.items():
        if period % p == 0:
            # Runs of a period are found from left to right, and two of them share fewer words than the period.
            left, right = 0, len(runs)
            while left < right:
                middle = (left + right) // 2
                if runs[middle][1] < high:
                    left = middle + 1
                else:
                    right = middle
            if left < len(runs) and runs[left][0] <= low:
                return True
    return False


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds behind its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    kept, end = [], 0
    # Dropped stretches in order, merged as they come.
    for low, high in sorted((start + period, stop) for start, stop, period in runs):
        if low > end:
            kept += words[end:low]
        end = max(end, high)
    return b" ".join(kept + words[end:])


def _found(texts: list[str], least: int) -> Iterable[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs and collapsed text of each text; texts of about ``BATCH_WORDS`` words are looked at together."""
    split = [text.encode().split() for text in texts]
    at = 0
    while at < len(split):
        numbers, parts, begins, total, first = {}, [], [], 0, at
        while at < len(split) and (at == first or total + len(split[at]) < BATCH_WORDS):
            words = split[at]
            begins.append(total)
            parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
            parts.append(np.array([-1 - at], np.int64))
            total += len(words) + 1
            at += 1
        longest = max(map(len, split[first:at]))
        own: list[list[tuple[int, int, int]]] = [[] for _ in begins]
        for low, high, p in runs_of(np.concatenate(parts), longest, least):
            text = int(np.searchsorted(begins, low, "right")) - 1
            own[text].append((low - begins[text], high - begins[text], p))
        for words, runs in zip(split[first:at], own, strict=True):
            yield runs, _collapsed(words, runs)


def periodic_runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, runs and collapsed_text.

    ``runs`` are (start, length, period) by start, then period: the stretches of ``least`` or more words that hold
    their smallest period twice or more and that no neighbouring word extends, words being numbered from 0.
    ``collapsed_text`` has the words that no run holds behind its first period, joined by a blank.

    Null, empty and blank texts have no runs and an empty ``collapsed_text``. A null doc_id stays null; repeated rows
    give repeated rows; an empty table gives none; texts of any length are taken whole, one that is longer than a
    batch alone. Other columns are not looked at.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                runs, left = [], []
                for own, collapsed in _found(part.column("text").to_pylist(), least):
                    runs.append([{"start": a, "length": b - a, "period": p} for a, b, p in own])
                    left.append(collapsed.decode())
                columns = [part.column("doc_id"), pa.array(runs, fields), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed_text"])

    return docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text")).mapInArrow(find, RUNS_SCHEMA)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, where in a tenth of the documents, by the CRC-32 of doc_id, the words from one on
    repeat a few of themselves until the end. A null doc_id leaves a text as it is."""
    mark = F.crc32(F.col("doc_id").cast("string"))
    seed = F.floor(mark / 10)
    words = F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0))
    n = F.col("_n")
    begin = F.pmod(seed, n)
    period = F.lit(1) + F.floor((n - begin) / (F.lit(3) + F.pmod(seed, F.lit(8))))
    place = lambda i: F.when(i < begin, i).otherwise(begin + F.pmod(i - begin, period))
    moved = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_words", place(i.cast("bigint")).cast("int")))
    chosen = F.pmod(mark, F.lit(10)) == 0
    split = docs.select("doc_id", "text", F.when(chosen, words).alias("_words")).withColumn("_n", F.size("_words").cast("bigint"))
    return split.select("doc_id", F.when(n > 0, F.concat_ws(" ", moved)).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, number of runs, the longest run and digests of ``periodic_runs``; without a run its figures are null."""
    order = lambda r: F.struct(r["length"].alias("a"), (-r["start"]).alias("b"), (-r["period"]).alias("c"))
    longest = F.array_max(F.transform("runs", order))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    lines = F.array_join(F.transform("runs", line), "")
    return found.withColumn("_longest", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_longest.b")).alias("start"),
        F.col("_longest.a").alias("length"),
        (-F.col("_longest.c")).alias("period"),
        F.expr("(1000 * _longest.a) div -_longest.c").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


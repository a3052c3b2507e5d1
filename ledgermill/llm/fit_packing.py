"""Packing documents into as few token sequences as possible by exact complements, then best fit.

Only documents longer than a sequence are cut; what is packed are the pieces shorter than one. How many
there are of each length is all that a plan depends on, and there are fewer lengths than a sequence has
tokens. Longest lengths first, the gap that a length leaves is looked up among the sums of one, two and
three lengths that are left; a combination that fills the gap exactly is used as often as the counts
allow. Sums are hashed as they are asked for, and since counts only fall, a sum without a combination
stays without one. What is left then goes, longest first, where it fits best.

The plan has some thousand patterns at any corpus size; pieces are numbered within their length in Spark
and each number looked up in the plan.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.packing import length_counts, pieces, placed
from ledgermill.session import stored

CAPACITY = 4096


class Sums:
    """Combinations of one, two or three available lengths by their sum."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self._pairs: dict[int, tuple[int, int]] = {}
        self._triples: dict[int, tuple[int, int, int]] = {}
        self._no_pair: set[int] = set()
        self._no_triple: set[int] = set()

    def holds(self, lengths: tuple[int, ...]) -> bool:
        """Whether all of these are there at once."""
        return all(self.left[n] >= lengths.count(n) for n in set(lengths))

    def one(self, total: int) -> tuple[int, ...] | None:
        return (total,) if self.left[total] else None

    def two(self, total: int) -> tuple[int, ...] | None:
        """The most uneven pair of the sum."""
        known = self._pairs.get(total)
        if known is not None and self.holds(known):
            return known
        if total < 2 or total in self._no_pair:
            return None
        small = np.arange(1, total // 2 + 1)
        able = (self.left[small] > 0) & (self.left[total - small] > 0)
        if total % 2 == 0:
            able[-1] = self.left[total // 2] > 1
        found = np.flatnonzero(able)
        if not len(found):
            self._no_pair.add(total)
            return None
        a = int(small[found[0]])
        self._pairs[total] = (total - a, a)
        return self._pairs[total]

    def three(self, total: int) -> tuple[int, ...] | None:
        """A triple of the sum, its longest length as long as can be."""
        known = self._triples.get(total)
        if known is not None and self.holds(known):
            return known
        if total < 3 or total in self._no_triple:
            return None
        short = False
        for longest in (np.flatnonzero(self.left[1 : total - 1]) + 1)[::-1].tolist():
            if 3 * longest < total:
                break
            pair = self.two(total - longest)
            if pair and self.holds((longest, *pair)):
                self._triples[total] = (longest, *pair)
                return self._triples[total]
            short |= pair is not None
        if not short:
            self._no_triple.add(total)
        return None


def exact_fills(sums: Sums, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, lengths in each) of bins filled to the last token by up to four pieces; ``sums.left`` goes down.

    A length is set aside while its gap is looked up. A sum found missing then may only lack combinations with that
    length, all of which have had their turn with it.
    """
    plan: list[tuple[int, dict[int, int]]] = []
    for length in range(capacity - 1, 0, -1):
        gap = capacity - length
        for look in (sums.one, sums.two, sums.three):
            while sums.left[length]:
                sums.left[length] -= 1
                found = look(gap)
                sums.left[length] += 1
                if found is None:
                    break
                used: dict[int, int] = {}
                for n in (length, *found):
                    used[n] = used.get(n, 0) + 1
                bins = min(int(sums.left[n]) // k for n, k in used.items())
                plan.append((bins, used))
                for n, k in used.items():
                    sums.left[n] -= bins * k
    return plan


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, lengths in each): longest first, each into the smallest gap it fits.

    Bins with equal gap and content are handled as one class with a number.
    """
    gaps: list[int] = []
    classes: dict[int, list[tuple[int, dict[int, int]]]] = {}
    closed: list[tuple[int, dict[int, int]]] = []

    def add(gap: int, bins: int, used: dict[int, int]) -> None:
        if not gap:
            closed.append((bins, used))
            return
        if gap not in classes:
            classes[gap] = []
            insort(gaps, gap)
        classes[gap].append((bins, used))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                bins, used = classes[gap].pop()
                if not classes[gap]:
                    del classes[gap], gaps[at]
            else:
                gap, bins, used = capacity, left, {}
            # As many pieces of the length as fit one bin, in as many bins as they fill.
            each = min(gap // length, left)
            filled = min(bins, left // each)
            add(gap - each * length, filled, {**used, length: used.get(length, 0) + each})
            left -= filled * each
            if used and bins > filled:
                add(gap, bins - filled, used)
    return closed + [entry for gap in gaps for entry in classes[gap]]


def plan_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, lengths in each) for all counted lengths, which are below ``capacity``."""
    sums = Sums(counts, capacity)
    plan = exact_fills(sums, capacity)
    return plan + best_fit({int(n): int(sums.left[n]) for n in np.flatnonzero(sums.left)}, capacity)


def fit_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Pack ``docs`` (``doc_id``, ``text``) into few sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece (from 0), start (its document's ids before it), length, ids_crc32,
    sequence_id and offset. Only documents with more than ``capacity`` ids are cut, into pieces of
    ``capacity``; the last may be shorter.

    Null and empty texts are the end id alone. Null doc_ids stay null; repeated rows are packed each; an empty
    table gives no rows; texts of any length are cut whole. Equal lengths are told apart by doc_id, start and
    ids only, so which of two equal rows goes where has no meaning. Other columns are not looked at.
    """
    cut = stored(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    counts = length_counts(cut)
    plan = plan_fit({n: c for n, c in counts.items() if n < capacity}, capacity)
    number = F.floor(F.col("start") / capacity).cast("int")
    found = placed(cut, counts, plan, capacity).withColumn("piece", number)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

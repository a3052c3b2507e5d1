"""Quality rules, among them the repetition that a suffix array shows.

The suffixes of each text, in words, are sorted by prefix doubling, those of many texts at once. Two
neighbours in that order have the longest common prefixes that there are, so an LCP interval is a
maximal repeated passage and the suffixes in it are its places. Passages of at least MIN_REPEAT words
have their places united; a text goes if they cover too large a part of it or if the longest passage
is too long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.texts import words_of

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
# The limits of the base rules.
MIN_WORDS, REPEAT_SHARE = 50, 50
# The method's parameters: shortest passage that counts, largest covered part, longest passage in words.
MIN_REPEAT, MOST_COVERED, LONGEST = 16, 0.25, 100
# Words whose suffixes are sorted together; a longer text is sorted alone.
SORTED_WORDS = 1 << 17
_BLANK = " \t\n\x0b\x0c\r"


def suffix_order(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of several texts in a row and the ranks after each doubling.

    ``words`` are numbers of words, ``doc`` the texts they belong to, ascending. Suffixes end with their
    text and lie by text first. Ranks of level k are equal where two suffixes share 2^k words.
    """
    n = len(words)
    order = np.lexsort((words, doc))
    new = np.append(True, (words[order[1:]] != words[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]]))
    begin = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = begin[np.cumsum(new) - 1]
    ends = np.searchsorted(doc, doc, "right")
    levels, step = [rank], 1
    sizes = np.diff(np.append(begin, n))
    active = order[np.repeat(sizes, sizes) > 1]
    while len(active):
        after = active + step
        following = np.where(after < ends[active], levels[-1][np.minimum(after, n - 1)], -1)
        own = levels[-1][active]
        by = np.lexsort((following, own))
        active, own, following = active[by], own[by], following[by]
        outer = np.append(True, own[1:] != own[:-1])
        inner = outer | np.append(True, following[1:] != following[:-1])
        at = np.arange(len(active))
        outer_begin, inner_begin = np.flatnonzero(outer), np.flatnonzero(inner)
        rank = levels[-1].copy()
        rank[active] = own + inner_begin[np.cumsum(inner) - 1] - outer_begin[np.cumsum(outer) - 1]
        levels.append(rank)
        step *= 2
        sizes = np.diff(np.append(inner_begin, len(at)))
        active = active[np.repeat(sizes, sizes) > 1]
    order = np.empty(n, np.int64)
    order[levels[-1]] = np.arange(n)
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], doc: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in ``order``."""
    n = len(order)
    found = np.zeros(n, np.int64)
    ends = np.searchsorted(doc, doc, "right")
    pairs = np.flatnonzero(np.append(False, levels[0][order[1:]] == levels[0][order[:-1]]))
    i, j = order[pairs - 1], order[pairs]
    end_i, end_j = ends[i], ends[j]
    shared = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = i + shared, j + shared
        inside = (a < end_i) & (b < end_j)
        equal = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        shared += equal * (1 << k)
    found[pairs] = shared
    return found


def _covered(begin: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n places the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, begin + length, -1)
    return np.cumsum(steps[:-1]) > 0


def _repeats(split: list[list[bytes]], min_repeat: int) -> list[tuple[int, int, int]]:
    """Per text: words in 3-word windows found twice, words covered by repeated passages, longest passage."""
    counts = np.array([len(words) for words in split], np.int64)
    n = int(counts.sum())
    if not n:
        return [(0, 0, 0)] * len(split)
    digest = xxhash.xxh64_intdigest
    words = np.fromiter((digest(w) for ws in split for w in ws), np.uint64, n)
    doc = np.repeat(np.arange(len(counts)), counts)
    order, levels = suffix_order(words, doc)
    prefixes = common_prefixes(order, levels, doc)
    longest = np.zeros(n, np.int64)
    longest[order] = np.maximum(prefixes, np.append(prefixes[1:], 0))
    # A place that shares 3 words with another is a 3-word window found twice.
    three = np.flatnonzero(longest >= 3)
    in_three = _covered(three, np.full(len(three), 3), n)
    long = np.flatnonzero(longest >= min_repeat)
    in_long = _covered(long, longest[long], n)
    edges = np.append(0, np.cumsum(counts))

    def per_text(values: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(values))
        return sums[edges[1:]] - sums[edges[:-1]]

    most = np.zeros(len(split), np.int64)
    np.maximum.at(most, doc, longest)
    return list(zip(per_text(in_three).tolist(), per_text(in_long).tolist(), most.tolist(), strict=True))


def _duplicate_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return len(lines) - len(set(lines))


def quality_rules(
    docs: DataFrame, min_repeat: int = MIN_REPEAT, most_covered: float = MOST_COVERED, longest: int = LONGEST
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``) the base counts and the verdict.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and of the
    suffix array n_covered (words in repeated passages of ``min_repeat`` words or more) and
    longest_repeat (words). A row is kept if no base rule failed, its passages cover at most
    ``most_covered`` of its words and none is longer than ``longest``.

    Null texts have no words and fail. Repeated rows are judged each; null doc_ids stay null; an empty
    table gives no rows. Other columns are not looked at. A text is judged whole, however long.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            split = [words_of(t) for t in texts]
            repeats: list[tuple[int, int, int]] = []
            begin, size = 0, 0
            for at, words in enumerate(split):
                size += len(words)
                if size >= SORTED_WORDS:
                    repeats += _repeats(split[begin : at + 1], min_repeat)
                    begin, size = at + 1, 0
            repeats += _repeats(split[begin:], min_repeat)
            rows = [
                (
                    len(words),
                    len(text) - sum(map(text.count, _BLANK)),
                    sum(map(text.count, SYMBOLS)),
                    _duplicate_lines(text),
                    *found,
                )
                for text, words, found in zip(texts, split, repeats, strict=True)
            ]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    counted = docs.select("doc_id", "text").mapInArrow(
        count, ", ".join(["doc_id bigint", *(f"{name} bigint" for name in names)])
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))
    fine = (F.col("n_covered") <= most_covered * F.col("n_words")) & (F.col("longest_repeat") <= longest)
    return counted.select(
        "doc_id",
        *names[:5],
        failed.alias("base_failed"),
        (~failed & fine).alias("kept"),
        *names[5:],
    )

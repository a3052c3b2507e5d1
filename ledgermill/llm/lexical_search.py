"""Ranked lexical search over a K2-treap of the term-document grid.

Documents are cut into ranges of bounded size. A range's grid has a row for each term that some item asks for,
a column for each document, and in a cell what the term adds to the document's score. The grid is stored as a
compressed quadtree: a cell of a level covers a square of cells of the level below, knows the largest impact in
it and which of its four quarters hold anything; empty ones take no room.

An item descends from the root along the paths of all its rows at once. What it descends by is a range of
documents together with the cells in which its rows cross that range; the sum of their maxima bounds the score
of every document in it. The best range is halved first, some hundred at a time, until no bound reaches the
k-th score found; ranges of one document have their score for a bound. Scores found in one range of documents
carry over to the next in a task, so most of the later ranges are left at their roots.

Items are taken in blocks whose terms are bounded, each against all documents; what leaves a task is at most k
documents an item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.texts import text_of
from ledgermill.session import stored

# Constants of the score.
SCALE, BASE, LENGTH_PART, SATURATION, WEIGHT = 1_000_000_000, 100, 50, 20, 1_000
MOST = 50
# Terms of the items that are looked for in one pass over the documents, about: a dictionary of some hundred MB.
BLOCK_TERMS = 1_000_000
# Documents and cells of a range, whichever is reached first.
RANGE_DOCS, RANGE_CELLS = 1 << 14, 1 << 20
# Ranges of documents halved at once.
HALVED = 256
# Into how many parts an item's candidates of all tasks are cut before they meet.
PARTS = 64

# Bytes that are no part of a term become blanks, A-Z small letters; bytes beyond ASCII are all part of terms.
_TERM_BYTES = bytes(
    b if b > 0x7F or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)
POSTING_SCHEMA = "doc_id bigint, n bigint, docs bigint, terms array<int>, times array<int>"


def terms_of(text: str) -> list[bytes]:
    """Terms of a text: letters, digits and all characters beyond ASCII in a row, A-Z in lower case."""
    return text.encode().translate(_TERM_BYTES).split()


def _items(items: DataFrame) -> DataFrame:
    """item_id, once for every distinct term, and the term."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_id"), batch.column("text").to_pylist(), strict=True):
                own = sorted(set(terms_of(text)))
                yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(own), pa.int64()), pa.array(own, pa.binary())], ["item_id", "term"])

    rows = items.select(F.col("item_id").cast("bigint"), text_of().alias("text"))
    return stored(rows.mapInArrow(split, "item_id bigint, term binary").distinct(), "item-terms")


def _postings(docs: DataFrame, known) -> DataFrame:
    """Per document with known terms its number of terms, and which known ones it has how often; what other documents
    add to the number of documents with a term, and of terms, is one row without terms per batch."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1_024):
                part = batch.slice(at, 1_024)
                found, sizes = [], np.zeros(part.num_rows, np.int64)
                for k, text in enumerate(part.column("text")):
                    own = terms_of(text.as_py())
                    sizes[k] = len(own)
                    numbers = np.fromiter((number.get(term, -1) for term in own), np.int64, len(own))
                    found.append(numbers[numbers >= 0] + (k << 32))
                cells, times = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64),) * 2
                ends = np.searchsorted(cells, np.arange(1, part.num_rows + 1) << 32)
                counts = np.diff(ends, prepend=0)
                own = np.flatnonzero(counts)
                offsets = pa.array(np.append(0, ends[own]), pa.int32())
                other = (counts == 0) & (sizes > 0)
                ids = part.column("doc_id").take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([ids, pa.nulls(1, pa.int64())]),
                        pa.array(np.append(sizes[own], sizes[other].sum())),
                        pa.array(np.append(np.ones(len(own), np.int64), other.sum())),
                        _lists(offsets, (cells & 0xFFFFFFFF).astype(np.int32)),
                        _lists(offsets, times.astype(np.int32)),
                    ],
                    ["doc_id", "n", "docs", "terms", "times"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    return stored(rows.mapInArrow(post, POSTING_SCHEMA), "postings")


def _lists(offsets: pa.Array, values: np.ndarray) -> pa.Array:
    """Lists by their offsets, and an empty one behind them."""
    return pa.ListArray.from_arrays(pa.concat_arrays([offsets, offsets.slice(len(offsets) - 1)]), pa.array(values))


def weight(n_docs: int, n_with: int) -> int:
    """Weight of a term that ``n_with`` of ``n_docs`` documents have."""
    return math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * n_with + 1)))


def impacts(weights: np.ndarray, times: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to the score of a document with ``sizes`` terms that has it ``times`` times."""
    length = BASE - LENGTH_PART + (LENGTH_PART * sizes * n_docs) // n_terms
    return weights * ((SCALE * times) // (1_000 * times + SATURATION * length))


class Treap:
    """The quadtree of a grid: per level, root first, each cell's largest impact and its four quarters in the next level.

    Quarters are numbered 2 * (lower half of the rows) + (right half of the columns); -1 is an empty one. A level has
    one more cell at its end, which is empty: what -1 finds.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impact: np.ndarray, height: int) -> None:
        self.height = height
        # Cells in the order of their interleaved bits, so that quarters of one square follow each other.
        place = _spread(rows) << 1 | _spread(columns)
        order = np.argsort(place)
        place, top = place[order], impact[order]
        self.most: list[np.ndarray] = [np.append(top, 0)]
        self.quarters: list[np.ndarray] = []
        for _ in range(height):
            above = place >> 2
            begins = np.flatnonzero(np.append(True, above[1:] != above[:-1]))
            cell = np.cumsum(np.append(0, (above[1:] != above[:-1]).astype(np.int64)))
            quarters = np.full((len(begins) + 1, 4), -1, np.int32)
            quarters[cell, place & 3] = np.arange(len(place))
            self.quarters.append(quarters)
            top, place = np.maximum.reduceat(top, begins), above[begins]
            self.most.append(np.append(top, 0))
        self.most.reverse()
        self.quarters.reverse()


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of numbers below 2^31, each with an empty place above it."""
    x = x.astype(np.int64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        x = (x | x << shift) & mask
    return x


def _paths(rows: np.ndarray, height: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """How an item's rows part on their way down: per level below the root the place of each path's parent, its half, and
    how many rows take it."""
    steps, above = [], np.zeros(1, np.int64)
    for level in range(1, height + 1):
        own, times = np.unique(rows >> (height - level), return_counts=True)
        steps.append((np.searchsorted(above, own >> 1), 2 * (own & 1), times))
        above = own
    return steps


class Best:
    """The k best documents of an item so far: score, and doc_id as the order of equal scores."""

    def __init__(self, k: int) -> None:
        self._k = k
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (np.append(a, b) for a, b in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        order = np.lexsort((ids, nulls, -scores))[: self._k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]

    def least(self) -> tuple[int, int]:
        """Score and doc_id that have to be beaten; a score of 0 never counts."""
        if len(self.scores) < self._k:
            return 1, np.iinfo(np.int64).max
        return int(self.scores[-1]), np.iinfo(np.int64).max if self.nulls[-1] else int(self.ids[-1])


def search(treap: Treap, rows: np.ndarray, first_ids: list[np.ndarray], ids: np.ndarray, nulls: np.ndarray, best: Best) -> int:
    """Add to ``best`` the documents of a range that belong there, best ranges first; the number of ranges looked at.

    ``first_ids`` has, per level, the smallest doc_id of each range of columns.
    """
    steps, looked = _paths(rows, treap.height), 0
    # Per level the ranges still open: their columns' number, bound, and a cell for each of the item's paths there.
    waiting: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in range(treap.height + 1)]
    root = np.zeros((1, 1), np.int32)
    waiting[0].append((np.zeros(1, np.int64), treap.most[0][:1] * len(rows), root))
    while True:
        level = max(
            (n for n, parts in enumerate(waiting) if parts), key=lambda n: max(int(part[1].max()) for part in waiting[n]), default=None
        )
        if level is None:
            return looked
        columns, bounds, cells = (np.concatenate(part) for part in zip(*waiting[level], strict=True))
        waiting[level] = []
        least, least_id = best.least()
        open_ = (bounds > least) | (bounds == least) & (first_ids[level][columns] <= least_id)
        columns, bounds, cells = columns[open_], bounds[open_], cells[open_]
        if level == treap.height:
            looked += len(columns)
            best.add(bounds, ids[columns], nulls[columns])
            continue
        if len(columns) > HALVED:
            order = np.argpartition(-bounds, HALVED)
            later = order[HALVED:]
            waiting[level].append((columns[later], bounds[later], cells[later]))
            order = order[:HALVED]
            columns, cells = columns[order], cells[order]
        if not len(columns):
            continue
        looked += len(columns)
        parent, half, times = steps[level]
        quarters, most = treap.quarters[level], treap.most[level + 1]
        for right in (0, 1):
            below = quarters[cells[:, parent], half + right]
            bound = most[below] @ times
            some = bound >= least
            if some.any():
                waiting[level + 1].append((2 * columns[some] + right, bound[some], below[some]))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """doc_id and number of terms of the documents of a range; column, term and times of its cells."""
    ids, sizes, counts, terms, times, docs, cells = [], [], [], [], [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1_024):
            part = batch.slice(at, 1_024)
            lists = part.column("terms")
            ids.append(part.column("doc_id"))
            sizes.append(part.column("n").to_numpy(zero_copy_only=False))
            counts.append(np.diff(lists.offsets.to_numpy()))
            terms.append(lists.flatten().to_numpy(zero_copy_only=False))
            times.append(part.column("times").flatten().to_numpy(zero_copy_only=False))
            docs, cells = docs + part.num_rows, cells + len(terms[-1])
            if docs + 1_024 > RANGE_DOCS or cells >= RANGE_CELLS:
                yield _together(ids, sizes, counts, terms, times)
                ids, sizes, counts, terms, times, docs, cells = [], [], [], [], [], 0, 0
    if cells:
        yield _together(ids, sizes, counts, terms, times)


def _together(ids, sizes, counts, terms, times):
    size, count = np.concatenate(sizes), np.concatenate(counts)
    # Columns by length, which bounds like best, then in the order of equal scores.
    known = pa.concat_arrays(ids)
    nulls = known.is_null().to_numpy(zero_copy_only=False)
    numbers = known.fill_null(0).to_numpy()
    order = np.lexsort((numbers, nulls, size))
    column = np.empty(len(order), np.int64)
    column[order] = np.arange(len(order))
    return numbers[order], nulls[order], size[order], np.repeat(column, count), np.concatenate(terms).astype(np.int64), np.concatenate(times).astype(np.int64)


def _first_ids(ids: np.ndarray, nulls: np.ndarray, height: int) -> list[np.ndarray]:
    """Per level the smallest doc_id of each range of columns; a null is the largest."""
    last = np.iinfo(np.int64).max
    own = np.full(1 << height, last)
    own[: len(ids)] = np.where(nulls, last, ids)
    levels = [own]
    for _ in range(height):
        own = own.reshape(-1, 2).min(1)
        levels.append(own)
    return levels[::-1]


def _searched(postings: DataFrame, asked, weights, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item, doc_id and score: at most k documents an item from each task."""

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, own = asked.value, weights.value
        best = [Best(k) for _ in items]
        for ids, nulls, sizes, columns, terms, times in _ranges(batches):
            impact = impacts(own[terms], times, sizes[columns], n_docs, n_terms)
            # A term without weight adds nothing; its rows are empty.
            worth = impact > 0
            if not worth.any():
                continue
            height = max(1, int(max(len(own), len(ids)) - 1).bit_length())
            treap = Treap(terms[worth], columns[worth], impact[worth], height)
            first_ids = _first_ids(ids, nulls, height)
            for rows, found in zip(items, best, strict=True):
                search(treap, rows, first_ids, ids, nulls, found)
        numbers = np.repeat(np.arange(len(best)), [len(b.scores) for b in best])
        if len(numbers):
            doc_ids = pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.nulls for b in best]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), doc_ids, pa.array(np.concatenate([b.scores for b in best]))], ["item", "doc_id", "score"]
            )

    rows = postings.filter(F.size("terms") > 0).select("doc_id", "n", "terms", "times")
    return rows.mapInArrow(seek, "item bigint, doc_id bigint, score bigint")


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = MOST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The k documents of ``docs`` (``doc_id``, ``text``) with the highest scores above 0 for each item of ``items``
    (``item_id``, ``text``): item_id, rank (from 1), doc_id, score; equal scores by ascending doc_id, null last.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case. With N documents that have a term, L
    terms in all and n in one document, a term that df of them have weighs floor(1000 ln((2 N + 2) / (2 df + 1))), and adds
    this times 10^9 tf div (1000 tf + 20 m) to a document that has it tf times, m being 50 + (50 n N) div L.

    Null and empty texts have no terms: such documents count nowhere, such items have no rows. Repeated rows of ``docs`` are
    documents of their own; rows of one item_id are one item with the terms of all of them, null being an item_id too.
    Without documents or items there are no rows; texts of any length are read whole. Other columns are not looked at.
    """
    spark = docs.sparkSession
    wanted = _items(items)
    # One pass over the documents for each block of items; blocks are as many as the items' terms need.
    blocks = wanted.count() // block_terms + 1
    found = None
    for block in range(blocks):
        own = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else wanted
        rows = own.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).orderBy("item_id").collect()
        ranked = _ranked_block(docs, rows, k)
        if ranked is not None:
            found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return found


def _ranked_block(docs: DataFrame, rows: list, k: int) -> DataFrame | None:
    """Ranks for some items, whose distinct terms are bounded by the size of a block."""
    spark = docs.sparkSession
    number: dict[bytes, int] = {}
    asked = [np.array([number.setdefault(bytes(term), len(number)) for term in row.terms], np.int64) for row in rows]
    if not number:
        return None
    postings = _postings(docs, spark.sparkContext.broadcast(number))
    n_docs, n_terms = postings.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return None
    # A number for each term of the block.
    counted = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    weights = np.zeros(len(number), np.int64)
    for row in counted:
        weights[row.term] = weight(n_docs, row.df)
    context = spark.sparkContext
    best = _searched(postings, context.broadcast([np.sort(a) for a in asked]), context.broadcast(weights), n_docs, n_terms, k)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # What tasks found meets in two steps, so that an item's candidates never come together all at once.
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    first = best.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    last = first.filter(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    # As many rows as the block has items.
    names = spark.createDataFrame([(n, row.item_id) for n, row in enumerate(rows)], "item bigint, item_id bigint")
    return last.filter(F.col("rank") <= k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")

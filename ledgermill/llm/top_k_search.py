"""Exact top-k by inner product, block at a time.

Vectors are dealt out to groups and, within a group, put in an order that brings like ones together and
cut into ranges, the blocks. A block knows the largest and smallest value of each component. For a
query the products with these add up to a bound on every score in the block. Each query takes blocks
from the highest bound down, scores a block's vectors through its forward index (the block's rows), and
stops at the first bound below the k-th score it has; an equal bound is still scored, since a tie may
go to a smaller id. A group gives its k best per query, and the best of these are the result.

Queries meet groups in batches: a task holds one batch and one group, both of bounded size.

Scaled components are whole numbers in doubles. Products that might not be exact there are made with Python's
whole numbers, so no vector is too large to take part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.session import stored

GROUP_ROWS, BLOCK_ROWS, QUERY_ROWS = 8_192, 64, 4_096
SCALE = 256
# Whole numbers are exact in doubles below this; every double beyond it is a whole number.
EXACT = 2.0**53
LEAST, MOST = -(2**63), 2**63 - 1
# Below any score: the square of the largest double has fewer bits.
NOTHING = -(1 << 4_096)


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the components as floor(scale * x) in doubles, of the vectors that take part."""

    def scaled(x: Column) -> Column:
        return x.cast("double") * F.lit(float(scale))

    def whole(x: Column) -> Column:
        return F.when(F.abs(scaled(x)) < F.lit(EXACT), F.floor(scaled(x)).cast("double")).otherwise(scaled(x))

    usable = F.forall("embedding", lambda x: F.coalesce(F.abs(scaled(x)) < F.lit(float("inf")), F.lit(False)))
    return embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable).select(
        "vec_id", F.transform("embedding", whole).alias("v")
    )


def _matrix(lists: list[list[float]], width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, which add nothing to a product."""
    made = np.zeros((len(lists), width))
    for row, values in zip(made, lists, strict=True):
        row[: len(values)] = values
    return made


def _largest(vectors: np.ndarray) -> np.ndarray:
    return np.abs(vectors).max(1, initial=0)


def _products(left: np.ndarray, right: np.ndarray, wide: bool) -> np.ndarray:
    """left @ right.T in whole numbers: 64-bit ones, or Python's if they may be ``wide``."""
    made = np.zeros((len(left), len(right)), object if wide else np.int64)
    # Rows whose products are exact in doubles are multiplied there; only the others need whole numbers of any length.
    limit = np.sqrt(EXACT / max(1, left.shape[1])) * 0.999
    small_left, small_right = _largest(left) < limit, _largest(right) < limit
    made[np.ix_(small_left, small_right)] = (left[small_left] @ right[small_right].T).astype(np.int64).astype(made.dtype)
    for l_rows, r_rows in ((~small_left, np.ones(len(right), bool)), (small_left, ~small_right)):
        if l_rows.any() and r_rows.any():
            exact = _whole(left[l_rows]) @ _whole(right[r_rows]).T
            made[np.ix_(l_rows, r_rows)] = exact.astype(made.dtype)
    return made


def _whole(values: np.ndarray) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(values)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best of every row: highest score, then smallest id."""
    if scores.dtype == object:
        # Ranks stand for the numbers, which have any length.
        scores = np.unique(scores, return_inverse=True)[1].reshape(scores.shape)
    else:
        scores = np.maximum(scores, -MOST)
    return np.lexsort((ids, -scores), axis=1)[:, :k]


def _below(scores: np.ndarray) -> np.ndarray:
    """Scores as doubles, those beyond what doubles hold as smaller ones."""
    if scores.dtype != object:
        return scores.astype(float)
    return np.array([-np.inf if s < -(1 << 1_000) else float(min(s, 1 << 1_000)) for s in scores])


def _cells(vectors: np.ndarray) -> np.ndarray:
    """An order in which like vectors are neighbours: by the nearest of some vectors spread over the group."""
    pivots = vectors[:: max(1, len(vectors) // 64)]
    with np.errstate(all="ignore"):
        near = (vectors @ pivots.T * 2 - (pivots**2).sum(1)).argmax(1)
    return np.argsort(near, kind="stable")


def best_in_group(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, block_rows: int = BLOCK_ROWS
) -> tuple[np.ndarray, np.ndarray, int]:
    """Per query the k best ids and scores of a group, and the number of scores computed.

    Where there are fewer than k, the score is ``LEAST``, or ``NOTHING`` where scores may be longer than 64 bits.
    """
    order = _cells(vectors)
    vectors, ids = vectors[order], ids[order]
    cuts = range(0, len(ids), block_rows)
    blocks = [(vectors[a : a + block_rows], ids[a : a + block_rows]) for a in cuts]
    highest = np.array([v.max(0) for v, _ in blocks])
    lowest = np.array([v.min(0) for v, _ in blocks])
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    # Floating sums of large products may come out a little low; widened, a bound stays a bound.
    with np.errstate(all="ignore"):
        bounds = up @ highest.T + down @ lowest.T
        bounds += np.abs(bounds) * 1e-12 + (up @ np.abs(highest).T - down @ np.abs(lowest).T) * 1e-12
        wide = bool(_largest(queries).max(initial=0) * _largest(vectors).max(initial=0) * queries.shape[1] >= 2.0**62)
    # A bound beyond the doubles leaves nothing out.
    bounds[~np.isfinite(bounds)] = np.inf
    turns = np.argsort(-bounds, axis=1, kind="stable")
    nothing = NOTHING if wide else LEAST
    scores = np.full((len(queries), k), nothing, object if wide else np.int64)
    found = np.full((len(queries), k), MOST, np.int64)
    active, n_scored = np.arange(len(queries)), 0
    for turn in range(len(blocks)):
        block_of = turns[active, turn]
        open_ = bounds[active, block_of] >= _below(scores[active, -1])
        active, block_of = active[open_], block_of[open_]
        if not len(active):
            break
        for b in np.unique(block_of):
            own = active[block_of == b]
            v, v_ids = blocks[b]
            new = _products(queries[own], v, wide)
            n_scored += new.size
            all_scores = np.hstack([scores[own], new])
            all_ids = np.hstack([found[own], np.broadcast_to(v_ids, new.shape)])
            own_row = all_ids == query_ids[own, None]
            all_scores[own_row], all_ids[own_row] = nothing, MOST
            best = _best(all_scores, all_ids, k)
            scores[own] = np.take_along_axis(all_scores, best, 1)
            found[own] = np.take_along_axis(all_ids, best, 1)
    return found, scores, n_scored


def _rows_of(query, query_id, vec_id, scores) -> pa.Table:
    kept = [_long(int(score)) for score in scores]
    return pa.table(
        {
            "_query": pa.array(query, pa.int64()),
            "query_id": pa.array(query_id, pa.int64()),
            "vec_id": pa.array(vec_id, pa.int64()),
            "score": pa.array([score for score, _ in kept], pa.int64()),
            "_beyond": pa.array([beyond for _, beyond in kept], pa.binary()),
        }
    )


def _long(score: int) -> tuple[int, bytes]:
    """A score as the nearest 64-bit integer, and what orders scores that share the first or last of them."""
    kept = min(max(score, LEAST), MOST)
    return kept, b"" if LEAST < kept < MOST else (score - NOTHING).to_bytes(514, "big")


def top_k(embeddings: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every row of ``embeddings`` that is a query.

    The score is the inner product of floor(scale * x); ties go to the smaller vec_id; all other rows
    are candidates, and a query with fewer gets them all.

    Rows without vec_id, and vectors that are null or hold components that are null or not finite (before or
    after scaling), take no part. Scores rank by their exact value; one that no 64-bit integer holds is
    given as the nearest. Rows that share a query's vec_id are not its candidates; a query that is
    repeated whole is answered once, and repeated candidates are ranked each. Vectors of unequal length
    count as if zeros followed; an empty table gives no rows. Other columns are not looked at.
    """
    vectors = stored(integer_vectors(embeddings, scale), "vectors")
    n = vectors.count()
    queries = vectors.filter(is_query).distinct().withColumn("_query", F.xxhash64("vec_id", "v"))
    n_queries = queries.count()
    n_groups, n_batches = n // GROUP_ROWS + 6, n_queries // QUERY_ROWS + 1
    groups = F.sequence(F.lit(0), F.lit(n_groups - 1))
    batches = F.sequence(F.lit(0), F.lit(n_batches - 1))
    # Vectors were stored, so a row's place in the table is the same whenever it is read; dealt out by it, copies of
    # one vector or one id spread over all groups.
    asked = queries.withColumn("_batch", F.pmod("_query", F.lit(n_batches)).cast("int")).select(
        "_batch", F.explode(groups).alias("_group"), "_query", "vec_id", "v"
    )
    dealt = vectors.withColumn(
        "_group", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n_groups)).cast("int")
    ).select(F.explode(batches).alias("_batch"), "_group", "vec_id", "v")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows_of([], [], [], [])
        asked_lists, dealt_lists = left.column("v").to_pylist(), right.column("v").to_pylist()
        width = max(map(len, asked_lists + dealt_lists))
        q, v = _matrix(asked_lists, width), _matrix(dealt_lists, width)
        q_ids = left.column("vec_id").to_numpy()
        found, scores, _ = best_in_group(q, q_ids, v, right.column("vec_id").to_numpy(), k)
        row, column = np.nonzero(scores != (NOTHING if scores.dtype == object else LEAST))
        return _rows_of(left.column("_query").to_numpy()[row], q_ids[row], found[row, column], scores[row, column])

    per_group = (
        asked.groupBy("_batch", "_group")
        .cogroup(dealt.groupBy("_batch", "_group"))
        .applyInArrow(best, "_query bigint, query_id bigint, vec_id bigint, score bigint, _beyond binary")
    )
    rank = F.row_number().over(Window.partitionBy("_query", "query_id").orderBy(F.desc("score"), F.desc("_beyond"), "vec_id"))
    return (
        per_group.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )

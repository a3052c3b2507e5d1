from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from ledgermill.llm.top_k_search import best_in_group, top_k

SCHEMA = "vec_id bigint, embedding array<float>, score string, rank string"


def test_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(n, [rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 1)]) for _ in range(8)]) for n in range(300)]
    rows += [(n, rows[7][1]) for n in range(300, 400)] + [(12, rows[3][1]), (12, rows[3][1])]
    rows += [(400, None), (401, [1.0, None]), (402, [math.nan] * 8), (403, [math.inf] * 8), (None, [9.0] * 8), (404, []), (405, [3.0])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = top_k(frame, F.col("vec_id") % 50 == 0, k=5).collect()
    usable = [
        (d, [math.floor(256 * float(np.float32(x))) for x in v])
        for d, v in rows
        if d is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    want = []
    for q, qv in usable:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v)), d) for d, v in usable if d != q)
            want += [(q, rank, d, -s) for rank, (s, d) in enumerate(scored[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_few_rows_and_none(spark):
    few = spark.createDataFrame([(0, [1.0], "", ""), (1, [1e6], "", "")], SCHEMA)
    assert [tuple(r) for r in top_k(few, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 65_536_000_000)]
    assert top_k(few.limit(0), F.col("vec_id") == 0).count() == 0


def test_very_large_components(spark):
    rng = random.Random(9)
    sizes = [1.0, 2.0**23, 2.0**31 / 256, 2.0**40, 3e38]
    rows = [(n, [float(np.float32(rng.choice(sizes) * rng.uniform(-1, 1))) for _ in range(4)]) for n in range(200)]
    rows += [(n, rows[n % 7][1]) for n in range(200, 230)] + [(n, [2.0**23 - 1] * 4) for n in range(250, 260)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = top_k(frame, F.col("vec_id") % 10 == 0, k=5).collect()
    whole = {d: [math.floor(256 * x) for x in v] for d, v in rows}
    want = []
    for q in whole:
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), d) for d, v in whole.items() if d != q)
            want += [(q, rank, d, min(max(-s, -(2**63)), 2**63 - 1)) for rank, (s, d) in enumerate(scored[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_components_beyond_doubles(spark):
    rows = [(0, [1e300, 1e300], "", ""), (1, [1e300, -1e300], "", ""), (2, [-1e305, 1.0], "", ""), (3, [1.7e308, 0.0], "", ""), (4, [2e300, 0.0], "", "")]
    frame = spark.createDataFrame(rows, SCHEMA.replace("float", "double"))
    # 256 * 1.7e308 is not finite.
    assert [tuple(r) for r in top_k(frame, F.col("vec_id") == 0).orderBy("rank").collect()] == [
        (0, 1, 4, 2**63 - 1), (0, 2, 1, 0), (0, 3, 2, -(2**63)),
    ]


def test_blocks_are_left_out():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (20, 16))
    vectors = np.floor(centres[rng.integers(0, 20, 4_000)] + rng.normal(0, 5, (4_000, 16)))
    ids = np.arange(4_000)
    found, scores, n_scored = best_in_group(vectors[:50], ids[:50], vectors, ids, 5)
    exact = vectors[:50] @ vectors.T
    exact[np.arange(50), np.arange(50)] = -np.inf
    assert (scores == -np.sort(-exact, axis=1)[:, :5]).all()
    assert n_scored < 0.5 * 50 * 4_000

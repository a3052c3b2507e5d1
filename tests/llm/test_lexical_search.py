from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgermill.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def simple_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, k=50):
    counted = [(d, Counter(simple_terms(text))) for d, text in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(simple_terms(text))
    found = []
    for item, terms in wanted.items():
        scores = []
        for d, c in counted:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c
            )
            if score:
                scores.append((-score, d is None, d or 0))
        for rank, (score, null, d) in enumerate(sorted(scores)[:k], 1):
            found.append((item, rank, None if null else d, -score))
    return sorted(found, key=str)


def made(rng, n):
    vocabulary = [f"t{i}" for i in range(60)] + ["Über", "日本", "x9", "Alpha"]
    words = lambda k: rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=k)
    rows = [(i * 3 % n, rng.choice([" ", "-", "\n", "_!"]).join(words(rng.choice([1, 3, 20, 80])))) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(70)]  # a group of equal scores, larger than k
    rows += [(None, rows[3][1]), (None, rows[3][1]), rows[4], rows[4], (n + 900, None), (n + 901, ""), (n + 902, "!? -"), (n + 903, "t1 " * 30_000)]
    items = [(i, " ".join(words(rng.choice([1, 2, 8, 30])))) for i in range(25)]
    items += [(50, None), (51, "..."), (52, "unseen"), (53, rows[5][1]), (None, "t1 t2"), (54, "t1 T1 t1"), (54, "t7")]
    rng.shuffle(rows)
    return rows, items


@pytest.mark.parametrize(("seed", "docs_in_range", "halved", "block_terms"), [(1, 1 << 14, 2_048, 10**6), (2, 1_024, 3, 10**6), (3, 1_024, 16, 60)])
def test_ranks_equal_brute_force(spark, docs, monkeypatch, seed, docs_in_range, halved, block_terms):
    monkeypatch.setattr(ls, "RANGE_DOCS", docs_in_range)
    monkeypatch.setattr(ls, "HALVED", halved)
    rows, items = made(random.Random(seed), 300)
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id bigint, text string, rank int, score string")
    got = ls.ranked_documents(docs(*rows), asked, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows, items)


def test_nothing_to_rank(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    for frame, items in ((docs(), some), (docs((1, "a")), none), (docs((1, None)), some), (docs((1, "c")), some)):
        assert ls.ranked_documents(frame, items).count() == 0


def test_treap_holds_every_cell():
    rng = np.random.default_rng(1)
    cells = np.unique(rng.integers(0, 64 * 64, 700))
    rows, columns, impact = cells // 64, cells % 64, rng.integers(1, 1_000, len(cells))
    treap = ls.Treap(rows, columns, impact, 6)
    grid = np.zeros((64, 64), np.int64)
    grid[rows, columns] = impact
    assert treap.most[0][0] == grid.max()
    for r in range(64):
        for c in range(64):
            cell = 0
            for level in range(6):
                bit = 5 - level
                cell = treap.quarters[level][cell, 2 * (r >> bit & 1) + (c >> bit & 1)]
                square = grid[r >> bit << bit :, c >> bit << bit :][: 1 << bit, : 1 << bit]
                assert treap.most[level + 1][cell] == square.max()
            assert treap.most[6][cell] == grid[r, c]


def test_ranges_are_left_out(monkeypatch):
    """Few of the 8,191 ranges of documents are looked at where few can be among the best."""
    monkeypatch.setattr(ls, "HALVED", 16)
    rng = np.random.default_rng(2)
    columns = np.repeat(np.arange(4_096), 3)
    rows = rng.integers(0, 200, len(columns))
    cells, at = np.unique(rows * 4_096 + columns, return_index=True)
    impact = np.sort(rng.integers(1, 1_000, len(columns)))[::-1][at]
    treap = ls.Treap(cells // 4_096, cells % 4_096, impact, 12)
    ids, nulls, best = np.arange(4_096), np.zeros(4_096, bool), ls.Best(5)
    looked = ls.search(treap, np.array([3, 50, 120]), ls._first_ids(ids, nulls, 12), ids, nulls, best)
    grid = np.zeros((200, 4_096), np.int64)
    grid[cells // 4_096, cells % 4_096] = impact
    scores = grid[[3, 50, 120]].sum(0)
    want = np.lexsort((ids, -scores))[:5]
    assert best.ids.tolist() == want.tolist() and best.scores.tolist() == scores[want].tolist()
    assert looked < 1_000


def test_terms():
    assert ls.terms_of("A-b_C9 Ünï\x7fx{z} É　日") == [w.encode() for w in simple_terms("A-b_C9 Ünï\x7fx{z} É　日")]

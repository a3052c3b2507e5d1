from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from ledgermill.llm import periodic_runs as pr


def simple_runs(words, least=12):
    """All runs by trying every period and every stretch that agrees with it."""
    n, stretches = len(words), {}
    for p in range(1, n // 2 + 1):
        start = 0
        while start + p < n:
            end = start
            while end + p < n and words[end] == words[end + p]:
                end += 1
            if end + p - start >= max(least, 2 * p):
                stretches.setdefault((start, end + p), p)  # the smallest period comes first
            start = end + 1
    return sorted((a, b, p) for (a, b), p in stretches.items())


def texts(rng, n):
    for k in range(n):
        kind = k % 5
        alphabet = [f"w{i}" for i in range(rng.choice([1, 2, 3, 40]))]
        words = [rng.choice(alphabet) for _ in range(rng.choice([0, 1, 11, 12, 40, 130]))]
        if kind == 0 and words:
            at, p = rng.randrange(len(words)), rng.randrange(1, 20)
            words[at:at] = (words[at : at + p] or ["z"]) * rng.randrange(2, 7)
        elif kind == 1:
            block = [rng.choice("abc") for _ in range(rng.randrange(1, 30))]
            words = words[:9] + block * rng.randrange(2, 9) + block[: rng.randrange(len(block))] + words[9:20]
            words = words * rng.choice([1, 1, 2, 3])
        elif kind == 2:  # a Fibonacci word
            a, b = ["a"], ["a", "b"]
            while len(b) < 120:
                a, b = b, b + a
            words = b
        elif kind == 3:  # Thue-Morse, of squares small and large
            words = [str(bin(i).count("1") % 2) for i in range(rng.randrange(1, 200))]
        yield words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    made = list(texts(random.Random(seed), 60))
    for words, (runs, _) in zip(made, pr._found([" ".join(w) for w in made], 12), strict=True):
        assert runs == simple_runs(words), words


def test_shorter_runs_on_request():
    made = list(texts(random.Random(9), 30))
    for words, (runs, _) in zip(made, pr._found([" ".join(w) for w in made], 4), strict=True):
        assert runs == simple_runs(words, 4), words


def planted(text, doc_id):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return [w.decode() for w in words]


def digests(doc_id, text):
    words = planted(text, doc_id)
    runs = simple_runs(words)
    dropped = {i for a, b, p in runs for i in range(a + p, b)}
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    row = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{a},{b - a},{p}\n" for a, b, p in runs)
    return (doc_id, len(runs), *row, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_digests_equal_brute_force(spark, docs):
    rng = random.Random(7)
    rows = [(n, rng.choice([" ", "\n", "\t "]).join(w)) for n, w in enumerate(texts(rng, 300))]
    rows += [(1_000, None), (1_001, ""), (1_002, " \n "), (None, "a b " * 20), rows[0], rows[0], (1_003, "é x\x1cy z " * 9)]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 15
    got = pr.run_digests(pr.periodic_runs(pr.with_planted_periods(docs(*rows))))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((digests(*r) for r in rows), key=str)


def test_no_documents(docs):
    assert pr.run_digests(pr.periodic_runs(pr.with_planted_periods(docs()))).count() == 0


def test_very_long_texts_cost_in_proportion():
    rng = random.Random(3)
    same = ["x"] * 200_000
    halves = [rng.choice("ab") for _ in range(100_000)] * 2
    nested = (["a"] * 50 + ["b"]) * 3_000
    for words, want in ((same, [(0, 200_000, 1)]), (halves, None), (nested, None)):
        ((runs, collapsed),) = pr._found([" ".join(words)], 12)
        assert want is None or runs == want
        if words is halves:
            assert (0, 200_000, 100_000) in runs
        if words is nested:
            assert runs == sorted([(51 * k, 51 * k + 50, 1) for k in range(3_000)] + [(0, len(words), 51)])
            assert collapsed.split() == [b"a", b"b"] or len(collapsed.split()) <= 52


def test_equal_hashes_do_not_make_a_run(monkeypatch):
    monkeypatch.setattr(pr, "_mixed", lambda marks: np.zeros_like(marks))
    words = [f"w{n}" for n in range(100)]
    ((runs, _),) = pr._found([" ".join(words)], 12)
    assert runs == []

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from ledgermill.llm import toxicity as tox

FILLER = ["stone", "river", "lantern", "meadow", "quiet", "walking", "idea", "table", "winter", "thinking", "orchard"]


@pytest.fixture(scope="module")
def restorer():
    texts = [" ".join([*FILLER, "blockhead", "muttonface", "the", "loser"]) for _ in range(20)]
    counts = np.bincount(tox._trigrams(texts, tox._code_table()), minlength=tox._N**3)
    return tox.Restorer(tox.costs_of(counts.astype(float)))


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("bl0ckh3ad", "blockhead"), ("b.l.o.c.k.h.e.a.d", "blockhead"), ("blooockhead", "blockhead"), ("l0$er", "loser"),
        ("mutt0n-f4ce", "muttonface"), ("|antern", "lantern"), ("river", "river"), ("", ""),
    ],
)
def test_disguises_are_read(restorer, written, meant):
    assert restorer.restore(written) == meant


def test_spelled_words_and_long_tokens(restorer):
    assert tox._spelled("a b c d word e f g".split()) == ["a b c d", "e f g"]
    assert restorer.restore("l o s e r") == "loser"
    assert len(restorer.restore("a1" * 20_000)) > 20_000


def test_search_finds_the_cheapest_path(restorer):
    import itertools
    import math

    def cost(path):
        total, a, b = 0.0, 0, 0
        for written, own in [*path, (" ", 0.0)]:
            total += own
            for c in written:
                code = 0 if c == " " else tox._CODE.get(c, tox._OTHER)
                total, a, b = total + restorer._costs[a, b, code], b, code
        return total

    for token in ("l0s3r", "1d1", "a b c", "sttone", "r|v3r"):
        lattice = restorer._lattice(token)
        best = min(itertools.product(*lattice), key=cost)
        found = min((p for p in itertools.product(*lattice) if "".join(w for w, _ in p).strip() == restorer._search(lattice)), key=cost)
        assert math.isclose(cost(best), cost(found))


def test_held_out_rows_are_told_apart(spark, docs):
    rng = random.Random(1)
    rows, labels, toxic = [], [], set()
    for n in range(900):
        words = [rng.choice(FILLER) for _ in range(40)]
        if n % 6 == 0:
            toxic.add(n)
            words[7:7] = ["blockhead", "muttonface"] if n % 12 else ["blockhead"] * 2
        rows.append((n, " ".join(words)))
        labels.append((n, int(n in toxic), "x"))
    disguised = {5_000 + n: t for n, t in enumerate(["a bl0ckhead and a muttonf4ce", "such a b l o c k h e a d, bl0ckhead"])}
    rows += list(disguised.items()) + [(6_000, None), (6_001, ""), (None, "blockhead muttonface blockhead"), (6_002, "river " * 30_000)]
    labels += [(None, 1, "x"), (3, None, "x"), (7_000, 1, "x")]
    got = tox.toxicity(docs(*rows, rows[0]), spark.createDataFrame(labels, "doc_id bigint, toxic int, text string")).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        want = r.doc_id is None or r.doc_id in toxic or r.doc_id in disguised
        assert r.predicted == int(want), r


def test_no_documents_or_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert tox.toxicity(docs(), labels).count() == 0
    rows = tox.toxicity(docs((1, "a b"), (2, None)), labels).collect()
    assert {r.predicted for r in rows} == {0}
    assert tox.without_toxic(docs((1, "a b")), labels).count() == 1


@pytest.mark.parametrize(
    ("token", "meant"),
    [("$$tupid", "stupid"), ("!diot", "idiot"), ("455", "ass"), ("4$$", "ass"), ("l0$$", "loss"), ("iiddiioott", "idiot")],
)
def test_signs_at_edges_and_doubled_letters_are_read(token, meant):
    texts = [" ".join([*FILLER, "stupid", "idiot", "ass", "loss"])] * 20
    counts = np.bincount(tox._trigrams(texts, tox._code_table()), minlength=tox._N**3)
    found = tox._readings(token, tox.Restorer(tox.costs_of(counts.astype(float))))
    assert meant in found, found


def test_words_with_blanks_are_weighed(restorer):
    weights = tox.Weights({"blockhead$": 4.0}, restorer)
    assert weights.of_text("a bl ock head, river") == weights.of_text("a block h3ad river") == 4.0
    assert weights.of_text("b l o c k h e a d") == weights.of_text("blockhead") == 4.0
    assert weights.of_text("a quiet river") == 0.0


def test_words_of_few_toxic_rows_carry_weight():
    weights = tox.weights_of({"seldom$": 29, "chance$": 5, "few$": 4}, {"chance$": 3}, 1_500, 13_000)
    assert set(weights) == {"seldom$"}


def test_the_tree_leaves_out_no_reading_that_carries_weight(restorer):
    """Weights with and without the shortcut are equal, on words disguised at random."""
    rng = random.Random(3)
    parts = {"blockhead$": 4.0, "mutton": 3.0, "los": 2.0, "rive": 1.0, "idea$": 1.5}
    weights = tox.Weights(parts, restorer)
    signs = {letter: sign for sign, letters in tox.STANDS_FOR.items() for letter in letters}
    for _ in range(1_500):
        word = list(rng.choice([*FILLER, "blockhead", "muttonface", "loser", "letter", "happen"]))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word))
            word[at] = rng.choice([signs.get(word[at][:1], "#"), word[at] * 2, word[at] * 3, word[at] + rng.choice(".-*$!|")])
        token = rng.choice(["", "$", "!", "("]) + "".join(word) + rng.choice(["", "$$", ",", "+"])
        want = max(map(weights.of_word, tox._readings(token, restorer)), default=0.0)
        assert weights[token] == want, token


def test_columns_named_like_helpers_stay(spark):
    names = ["_score", "score", "_whole", "_evidence", "evidence", "row", "toxic"]
    rows = [(n, "a quiet river", *(f"{name}{n}" for name in names)) for n in range(5)] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names))
    kept = tox.without_toxic(frame, spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int"))
    assert kept.columns == frame.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(rows)

from __future__ import annotations

import random

from ledgermill.llm.substring_dedup import lengths_to, remove_repeats


def brute_force(rows, window):
    split = [(d, [w for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w]) for d, t in rows]
    first = {}
    for d, words in split:
        for i in range(len(words) - window + 1):
            if d is not None:
                key = tuple(words[i : i + window])
                first[key] = min(d, first.get(key, d))
    found = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if d is not None and first[tuple(words[i : i + window])] < d:
                gone.update(range(i, i + window))
        found.append((d, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(found, key=str)


def test_equals_brute_force(spark, docs):
    rng = random.Random(3)
    vocabulary = [f"w{n}" for n in range(60)] + ["é", "x\x1cy"]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (12, 13, 14, 30, 200)]
    rows = [(1, None), (2, ""), (3, " \n"), (None, " ".join(passages[3])), (4, "few words")]
    for n in range(10, 80):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        rows.append((rng.choice([n, n, n, -n, 20]), rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(90, "again " * 30_000), (91, "again " * 30_000)]
    for window in (13, 5, 1):
        got = remove_repeats(docs(*rows).repartition(5), window)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(rows, window)


def test_levels_double():
    assert lengths_to(13) == [7, 13]
    assert lengths_to(13, 4) == [4, 7, 13]
    assert lengths_to(1) == [1]


def test_empty_table(docs):
    assert remove_repeats(docs()).count() == 0

from __future__ import annotations

import random
import re

import numpy as np

from ledgermill.llm import repetition_rules as rules


def longest_repeats(words):
    """Per place the longest passage from there that also begins elsewhere, by comparing all places."""
    found = [0] * len(words)
    for i in range(len(words)):
        for j in range(i):
            k = 0
            while i + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            found[i], found[j] = max(found[i], k), max(found[j], k)
    return found


def brute_force(text, min_repeat, most_covered, longest):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    places = longest_repeats(words)
    three = {i + k for i, n in enumerate(places) if n >= 3 for k in range(3)}
    covered = {i + k for i, n in enumerate(places) if n >= min_repeat for k in range(n)}
    most = max(places, default=0)
    failed = len(words) < 50 or 100 * len(three) > 50 * len(words)
    kept = not failed and len(covered) <= most_covered * len(words) and most <= longest
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(three), failed, kept, len(covered), most)


def test_equals_brute_force(docs):
    rng = random.Random(11)
    rows = [(0, None), (1, ""), (2, "\n \n\t"), (3, "a"), (3, "a"), (None, "x " * 60), (4, "é # <b> \x1c|" * 30)]
    for n in range(10, 70):
        vocabulary = [f"w{k}" for k in range(rng.choice([1, 2, 10, 200]))]
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 150))]
        if n % 2:
            at = rng.randint(0, len(words))
            words[at:at] = words[: rng.randint(0, 60)]
        rows.append((n, rng.choice([" ", "\n", " \n \n"]).join(words)))
    got = rules.quality_rules(docs(*rows), min_repeat=6, most_covered=0.3, longest=20).collect()
    want = [(d, *brute_force(t, 6, 0.3, 20)) for d, t in rows]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_long_repetition_is_found_whole():
    rng = random.Random(2)
    passage = [str(rng.random()).encode() for _ in range(5_000)]
    other = [str(rng.random()).encode() for _ in range(100)]
    assert rules._repeats([passage + other + passage, [], [b"a"] * 3_000], 16) == [
        (10_000, 10_000, 5_000),
        (0, 0, 0),
        (3_000, 3_000, 2_999),
    ]


def test_suffixes_are_in_order():
    rng = np.random.default_rng(0)
    doc = np.repeat(np.arange(5), [40, 0, 1, 30, 80][0:5])
    words = rng.integers(0, 3, len(doc)).astype(np.uint64)
    order, _ = rules.suffix_order(words, doc)
    ends = np.searchsorted(doc, doc, "right")
    assert order.tolist() == sorted(range(len(doc)), key=lambda i: (doc[i], words[i : ends[i]].tolist()))


def test_empty_table(docs):
    assert rules.quality_rules(docs()).count() == 0

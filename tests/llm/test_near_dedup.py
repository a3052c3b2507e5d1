from __future__ import annotations

import random

import numpy as np
import xxhash

from ledgermill.llm import near_dedup
from ledgermill.llm.components import components


def simple_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for white in "\t\n\x0b\x0c\r":
        lower = lower.replace(white, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force(rows, radius=2):
    marks = [simple_fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(marks[i] ^ marks[j]).count("1") <= radius and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    smallest = {}
    for (doc_id, _), g in zip(rows, group, strict=True):
        known = [x for x in (doc_id, smallest.get(g)) if x is not None]
        smallest[g] = min(known, default=None)
    return sorted(
        ((d, f"{m:016x}", smallest[g]) for (d, _), m, g in zip(rows, marks, group, strict=True)), key=str
    )


def test_equals_brute_force(spark, docs):
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta", "Ünit", "x", "delta,", "eps\x1cilon", "日本"]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (3, "one"), (None, "one"), (4, "ONE"), (None, "only here")]
    for n in range(5, 60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 40, 200]))]
        rows.append((n, " ".join(words)))
        if n % 3 == 0:
            words[rng.randrange(len(words))] = "changed"
            rows.append((n + 100, "\n".join(words)))
    rows.append((500, "very long " * 60_000))
    got = near_dedup.near_duplicates(docs(*rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_force(rows)


def test_empty_table(docs):
    assert near_dedup.near_duplicates(docs()).count() == 0
    assert near_dedup.one_per_group(docs()).count() == 0


def test_hot_buckets_are_dealt_out_again_without_losing_links(spark):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    marks = {base}
    while len(marks) < 400:
        mark = rng.choice(sorted(marks))
        for _ in range(rng.choice([1, 2, 3, 4])):
            mark ^= 1 << rng.randrange(64)
        marks.add(mark)
    marks |= {rng.getrandbits(64) for _ in range(100)}
    marks = np.array(sorted(marks), np.uint64)
    rows = list(zip(range(len(marks)), marks.view(np.int64).tolist(), strict=True))
    frame = spark.createDataFrame(rows, "doc_id bigint, _fp bigint")
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and bin(int(marks[i]) ^ int(marks[j])).count("1") <= 2:
                group = [group[j] if g == group[i] else g for g in group]
    first = {}
    for n, g in enumerate(group):
        first.setdefault(g, n)
    want = {rows[n][1]: first[g] for n, g in enumerate(group)}
    for bucket_rows in (3, 512):
        got = near_dedup.group_fingerprints(frame, bucket_rows=bucket_rows)
        assert {r._fp: r.component_id for r in got.collect()} == want


def test_any_radius_keeps_all_pairs():
    rng = np.random.default_rng(2)
    marks = rng.integers(0, 1 << 63, 150).astype(np.uint64)
    for n in range(1, 150, 2):
        marks[n] = marks[n - 1]
        for bit in rng.integers(0, 64, rng.integers(1, 6)):
            marks[n] ^= np.uint64(1) << np.uint64(bit)
    left = np.concatenate([np.arange(99, -1, -1), np.arange(49, -1, -1)])
    for radius in (1, 2, 3, 4):
        want = {
            (i, j)
            for i in range(150)
            for j in range(i + 1, i + 1 + left[i])
            if bin(int(marks[i] ^ marks[j])).count("1") <= radius
        }
        got = {(a, b) for i, j in near_dedup.close_pairs(marks, left, radius) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
        assert got == want


def test_one_row_of_each_group_stays(docs):
    frame = docs((2, "a b c d"), (1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "other"), (7, "words that differ"))
    kept = near_dedup.one_per_group(frame)
    assert kept.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [
        (1, "a b c d"),
        (7, "words that differ"),
        (None, "other"),
    ]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(n, n + 1) for n in range(100, 160)]
    star = [(0, n) for n in range(1, 50)]
    frame = spark.createDataFrame([*chain, *star, (70, 70), (5, 0)], "u bigint, v bigint")
    got = {(r.node, r.root) for r in components(frame).collect()}
    assert got == {(n, 100) for n in range(100, 161)} | {(n, 0) for n in range(50)}


def test_one_per_group_keeps_the_smallest_of_each_group(docs):
    rng = random.Random(8)
    rows = [(3_000, None), (3_001, ""), (None, "w1 w2"), (None, "")]
    for n in range(60):
        words = [f"w{rng.randrange(5_000)}" for _ in range(rng.choice([2, 30, 400]))]
        rows.append((n * 10, " ".join(words)))
        for k in range(n % 4):
            words[rng.randrange(len(words))] = f"x{k}"
            rows.append((n * 10 + k + 1, " ".join(words)))
        if n % 5 == 0:
            rows += [rows[-1]] * 2
    want = {(c, m) for _, m, c in brute_force(rows)}
    groups = {c for c, _ in want if c is not None}
    lone = {m for c, m in want if c is None}
    kept = near_dedup.one_per_group(docs(*rows)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(groups)
    assert sum(r.doc_id is None for r in kept) == len(lone)


def test_columns_named_like_helpers_stay(spark):
    names = ["_fp", "_root", "_kept", "_copies", "_own", "_name", "_mark", "row", "text_", "component_id"]
    rows = [(n, f"a b c {n % 3}", *(f"{name}{n}" for name in names)) for n in range(9)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names))
    kept = near_dedup.one_per_group(frame)
    assert kept.columns == frame.columns
    assert sorted(tuple(r) for r in kept.collect()) == [rows[n] for n in range(3)]

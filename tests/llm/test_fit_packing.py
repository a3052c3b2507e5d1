from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgermill.llm import fit_packing as fit

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def lengths_of(plan):
    placed = Counter()
    for bins, used in plan:
        for n, k in used.items():
            placed[n] += bins * k
    return placed


def test_sums_are_found_where_brute_force_finds_them():
    rng = random.Random(4)
    for _ in range(40):
        counts = {rng.randrange(1, 30): rng.randrange(1, 3) for _ in range(rng.randrange(1, 7))}
        sums = fit.Sums(counts, 60)
        for total in range(1, 60):
            for size, look in ((1, sums.one), (2, sums.two)):
                able = [c for c in combinations_with_replacement(sorted(counts), size) if sum(c) == total and sums.holds(c)]
                found = look(total)
                assert (found is not None) == bool(able)
                assert found is None or (sum(found) == total and sums.holds(found))
            found = sums.three(total)
            assert found is None or (len(found) == 3 and sum(found) == total and sums.holds(found))


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece_within_capacity(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 64, 4096])
    counts = Counter(min(capacity - 1, 1 + int(rng.expovariate(4 / capacity))) for _ in range(rng.choice([1, 40, 5_000])))
    plan = fit.plan_fit(dict(counts), capacity)
    assert lengths_of(plan) == counts
    assert all(0 < sum(n * k for n, k in used.items()) <= capacity and bins > 0 for bins, used in plan)
    used_bins, total = sum(bins for bins, _ in plan), sum(n * c for n, c in counts.items())
    # First fit in falling order needs at most 11/9 of the best number, and 6/9 of a bin.
    assert used_bins <= 11 / 9 * max(1, -(-total // capacity)) + 1 or used_bins <= sum(c for n, c in counts.items() if 2 * n > capacity) + 1


def test_exact_complements_leave_no_gap():
    counts = {4000: 5, 96: 5, 3000: 4, 1000: 2, 90: 2, 6: 4, 1090: 2, 2048: 6}
    plan = fit.plan_fit(counts, 4096)
    assert {sum(n * k for n, k in used.items()) for _, used in plan} == {4096}
    assert lengths_of(plan) == Counter(counts)


def test_huge_counts_need_few_patterns():
    counts = {n: 10**9 + n for n in range(1, 4096)}
    plan = fit.plan_fit(counts, 4096)
    assert lengths_of(plan) == Counter(counts)
    total = sum(n * c for n, c in counts.items())
    assert len(plan) < 30_000 and sum(bins for bins, _ in plan) <= total / 4096 * 1.01


def test_documents_are_packed_whole(spark, docs):
    rng = random.Random(2)
    rows = [(n, " ".join(rng.choice(["river", "stone", "tra", "Quiet"]) for _ in range(rng.choice([3, 50, 900, 5_000])))) for n in range(80)]
    rows += [(100, None), (101, ""), (None, "a row"), (5, rows[5][1]), (102, "x " * 4095), (103, "x " * 4096), (104, "x " * 8191)]
    got = fit.fit_documents(docs(*rows), WORD_BPE).collect()
    tokenizer, want = Tokenizer.from_file(WORD_BPE), Counter()
    for d, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 4096):
            part = ids[at : at + 4096]
            want[d, at // 4096, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    total = sum(r.length for r in got)
    assert len(sequences) <= total / 4096 * 1.05 + 1


def test_no_documents(docs):
    assert fit.fit_documents(docs(), WORD_BPE).count() == 0

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgermill.llm import packing
from ledgermill.llm.token_counts import token_counts
from ledgermill.llm.token_output import read_document, read_token_ids, with_checksums, write_token_ids
from ledgermill.llm.tokenizing import encoder, tokenizer_version
from ledgermill.session import scratch_path

BYTE, WORD = (public_tokenizers.path(f"{name}.json") for name in ("byte_bpe_50k", "word_bpe_49k"))
ODD = [
    "", " ", "  a  b", "a   b\n c \n\n d", "x <|endoftext|> y<|startoftext|>z", "!!\x1c!! a  b", "a　b \t c", "Σας ΑΣ",
    "é ́ x", "it's 'S don't  I'LL", "日本 語12 34", "a\r\n b", "​   x y", "long" * 40_000, " Foo.\nBar, baz!\n",
]


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_ids_of_the_library(path):
    rng = random.Random(1)
    letters = " \n\t aAbÉß,.;!?'sI1é́<|>\x1c 　日"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3_000)]
    known, library = encoder(*tokenizer_version(path)), Tokenizer.from_file(path)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [i.tolist() for i in known.ids(texts)] == want
    assert list(known.counts(texts)) == list(map(len, want))


@pytest.fixture
def rows():
    return [(n, t) for n, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no id"), (50, None), (4, "same id")]


def test_counts(docs, spark, rows):
    cache = scratch_path(spark, "cache")
    want = sorted(
        ((d, len((t or "").encode()), n := len(ids_of(BYTE, t or "")), n > 5) for d, t in rows), key=str
    )
    for part in (rows[:6], rows, rows):
        got = token_counts(docs(*part), BYTE, cache, limit=5).collect()
        if part is rows:
            assert sorted((tuple(r) for r in got), key=str) == want
    stored = spark.read.parquet(cache)
    # Each distinct text was encoded once, over all three runs.
    assert stored.count() == stored.select("content_digest").distinct().count() == len({t or "" for _, t in rows})
    assert token_counts(docs(), BYTE).count() == 0


def test_ids_survive_the_round_trip(docs, spark, rows):
    out = scratch_path(spark, "ids")
    write_token_ids(docs(*rows).repartition(4), WORD, out, end_id=2)
    tokens = read_token_ids(spark, out)
    got = sorted(tokens.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    start, left = 0, {}
    for d, t in rows:
        left.setdefault(d, []).append([*ids_of(WORD, t or ""), 2])
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == start and r.n_tokens == len(ids)
        left[r.doc_id].remove(ids)
        start += len(ids)
    assert not any(left.values())
    sums = {(r.start, r.ids_crc32) for r in with_checksums(tokens).collect()}
    assert sums == {(r.start, zlib.crc32(r.ids)) for r in got}
    assert sorted(read_document(spark, out, 4)) == sorted([[*ids_of(WORD, ODD[4]), 2], [*ids_of(WORD, "same id"), 2]])
    assert read_document(spark, out, 777) == []


def test_no_documents_give_no_ids(docs, spark):
    out = scratch_path(spark, "ids")
    write_token_ids(docs(), WORD, out, end_id=2)
    assert read_token_ids(spark, out).count() == 0
    assert packing.pack_documents(docs(), WORD).count() == 0


def test_packing_places_every_id_once(docs, rows):
    more = [(100 + n, "word " * n) for n in range(1, 60)]
    got = packing.pack_documents(docs(*rows, *more), WORD, capacity=32, end_id=1).collect()
    want = sorted(
        ((d, at, len(p := ids[at : at + 32]), zlib.crc32(np.array(p, "<u4").tobytes()), len(ids)) for d, t in [*rows, *more]
         for ids in [[*ids_of(WORD, t or ""), 1]] for at in range(0, len(ids), 32)), key=str
    )
    assert sorted((tuple(r)[:5] for r in got), key=str) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.padded_to))
    for parts in sequences.values():
        at = 0
        for offset, length, padded in sorted(parts):
            assert offset == at
            at += length
        assert at <= 32 and padded == (at if at & (at - 1) == 0 else 32)
    total = sum(r.length for r in got)
    assert len(sequences) <= total // 32 + 2


def test_fullest_equals_trying_all_counts():
    rng = random.Random(8)
    for _ in range(300):
        counts = {rng.randint(1, 20): rng.randint(1, 4) for _ in range(rng.randint(0, 5))}
        room = rng.randint(0, 40)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        used = packing.fullest(counts, room)
        assert all(0 < k <= counts[n] for n, k in used.items())
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= room)


def test_plan_is_short_and_uses_every_piece():
    rng = random.Random(9)
    counts = {n: rng.randint(1, 10**6) for n in range(1, 2049)}
    plan = packing.plan_bins(counts, 2048)
    left = dict(counts)
    for bins, used in plan:
        assert sum(n * k for n, k in used.items()) <= 2048
        for n, k in used.items():
            left[n] -= bins * k
    assert not any(left.values())
    assert len(plan) < 20_000
    assert sum(b for b, _ in plan) * 2048 < 1.01 * sum(n * c for n, c in counts.items()) + 2048

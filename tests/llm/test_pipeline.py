from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FILLER = [f"{a}{b}{c}" for a in ("tra", "mo", "lin", "sel") for b in ("ve", "ra", "ni") for c in ("n", "s", "ta", "do")]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)

    def text(n):
        return [rng.choice(FILLER) + rng.choice(["", ",", "."]) for _ in range(n)]

    rows, labels = [], []
    for n in range(600):
        words = text(rng.randint(30, 120))
        if n % 10 == 0:
            words[3:3] = ["blockhead"] * 3
            if n >= 400:  # disguised where it was not labelled
                words[3:6] = ["bl0ckhe4d", "b l o c k h e a d", "bloooockhead"]
        if n % 10 == 1:
            words[5:5] = ["mail", f"a{n}@example.org"]
        rows.append((n, " ".join(words), "en", ["a", "b", None][n % 3], 0))
        if n < 400:
            labels.append((n, 1, int(n % 10 == 0)))
    rows += [(1_000 + n, rows[n][1], "en", "a", 0) for n in range(1, 40)]
    rows += [(2_000, None, None, None, None), (2_001, "", "", "", 0), (None, "a row without id " * 9, "en", "b", 0)]
    root = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), rows


def test_each_stage_on_its_own_input(spark, corpus):
    root, rows = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns

    clean = corpus_pipeline.toxicity(spark, docs, root)
    assert clean.columns == columns
    ids = [r.doc_id for r in clean.collect()]
    toxic = set(range(0, 600, 10)) | set(range(1_010, 1_040, 10))
    assert Counter(ids) == Counter(d for d, *_ in rows if d not in toxic)

    single = corpus_pipeline.near_dedup(spark, docs, root)
    assert single.columns == columns
    kept = [r.doc_id for r in single.collect()]
    assert len(kept) == len(set(kept)) and not [d for d in kept if d is not None and 1_000 <= d < 2_000]
    assert set(range(600)) <= set(kept) and None in kept

    redacted = {r.doc_id: r for r in corpus_pipeline.pii(spark, docs, root).collect()}
    for d, text, *_ in rows:
        if d is not None and d % 10 == 1 and d < 600:
            assert redacted[d].text == text.replace(f"a{d}@example.org", "[EMAIL]")
        elif d is not None and d < 600:
            assert redacted[d].text == text

    mixed = corpus_pipeline.mixing(spark, docs, root)
    assert mixed.columns == columns
    counts = Counter(r.doc_id for r in mixed.collect())
    assert max(counts.values()) <= 2

    pieces = corpus_pipeline.packing(spark, docs, root).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for d, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want[d, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces) == want


def test_run_applies_all_stages(spark, corpus):
    root, _ = corpus
    pieces = corpus_pipeline.run(spark, root).collect()
    ids = {r.doc_id for r in pieces}
    assert not [d for d in ids if d is not None and (1_000 <= d < 2_000 or d < 600 and d % 10 == 0)]
    used = Counter()
    for r in pieces:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

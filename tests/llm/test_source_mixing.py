from __future__ import annotations

import pytest

from ledgermill.llm.source_mixing import mix, mix_report


def test_targets_stop_at_twice_the_source_and_the_rest_is_shared(docs):
    rows = [(n, "w " * 10, "a") for n in range(2)] + [(n, "w " * 10, "b") for n in range(10, 40)]
    rows += [(n, "w " * 5, None) for n in range(50, 60)] + [(99, None, "z"), (100, "", "a")]
    got = mix_report(docs(*rows)).collect()
    target = {r.source_size: r.target for r in got}
    # a: 20 words, weight 5; b: 300, weight 2; z: 0, weight 1; null: 50, weight 5; 555 words to share.
    assert target == {20: 40.0, 300: pytest.approx(415.0), 50: 100.0, 0: 0.0}
    assert all(r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in got)
    for size, wanted in target.items():
        assert abs(sum(r.taken for r in got if r.source_size == size) - wanted) <= 10
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix_report(docs(*rows)).collect()), key=str)


def test_mix_repeats_rows_and_keeps_columns(docs):
    frame = docs((1, "a b", "s"), (1, "a b", "s"), (2, "c", "s"), (3, "d e f", "t"), (None, "g", None))
    mixed = mix(frame)
    assert mixed.columns == frame.columns
    taken = sum(r.taken for r in mix_report(frame).collect())
    assert sum(len(r.text.split()) for r in mixed.collect()) == taken


def test_empty_table(docs):
    assert mix_report(docs()).count() == 0
    assert mix(docs()).count() == 0


def test_columns_named_like_helpers_are_kept(docs):
    names = ("_doc", "_id", "_size", "_source", "_no_source", "_tie", "_group", "_class", "_rank", "_copies", "_rate", "_target")
    frame = docs((1, "a b", "s"), (2, "c", "s"), (3, "d e f", "t"), (None, "g", None), (None, "h", None))
    clashing = frame.selectExpr("*", *(f"concat(text, '{name}') AS {name}" for name in names))
    mixed = mix(clashing)
    assert mixed.columns == clashing.columns
    assert sorted(map(tuple, mixed.select(*frame.columns).collect()), key=str) == sorted(map(tuple, mix(frame).collect()), key=str)
    assert all(row[name] == row.text + name for row in mixed.collect() for name in names)

"""Runs over stored layers: batch, replay, failure, reset and stream."""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from ledgermill import fixed_values as fx
from ledgermill.functions.rules import clean
from ledgermill.operators.netting import net_out
from ledgermill.plans import load
from ledgermill.operators.changes import net_changes
from ledgermill.operators.history import EDITED, replayed
from ledgermill.sources.layers import Busy, Layers
from ledgermill.streaming.refresh import csv_stream, start_refresh, start_watch

HEADER = ",".join(name.upper() for name in fx.BILLING_COLUMNS) + "\n"
FIRST = HEADER + (
    "910000011,10,ZF2,03/14/1996,64,M-0417,Broiler,G01,910000011\n"
    "910000012,10,ZF2,03/15/1996,50,M-0933,Layer,G01,910000012\n"
)
SECOND = HEADER + (
    "910000077,10,ZRE,03/14/1996,9,M-0417,Broiler,G01,910000011\n"
    "910000011,10,ZF2,03/14/1996,999,M-0417,Broiler,G01,910000011\n"
    "910000013,10,ZF2,06/02/1996,7,M-1205,Fish,G02,910000013\n"
)
STAMPS = ("created_at", "updated_at")


def table(layers, name, version):
    frame = load.layer(layers, name, version)
    return sorted((tuple(r) for r in frame.drop(*STAMPS).collect()), key=str)


@pytest.fixture
def put(tmp_path):
    def write(folder, name, text):
        path = tmp_path / folder
        path.mkdir(exist_ok=True)
        (path / name).write_text(text)
        return str(path)

    return write


def test_two_batches_and_a_replay(spark, put, tmp_path):
    out = str(tmp_path / "out")
    layers = Layers(spark, out)
    report = load.run(spark, put("one", "a.csv", FIRST), out)
    assert [(r.step, r.n_rows, r.status) for r in report.collect()] == [
        ("bronze", 2, "done"), ("silver", 2, "done"), ("gold", 2, "done"), ("dim_product", 2, "done"),
        ("dim_billing_type", 1, "done"), ("dim_date", 2, "done"), ("fact_sales", 2, "done"), ("views", None, "done"),
    ]
    second = put("two", "b.csv", SECOND)
    load.run(spark, second, out, batch_id=1002).collect()
    gold = {r.billing_document: (r.billing_qty_in_sku, r.return_qty, r.final_qty) for r in load.layer(layers, "gold", 1002).collect()}
    assert gold == {910000011: (64, 9, 55), 910000012: (50, 0, 50), 910000013: (7, 0, 7)}
    silver = load.layer(layers, "silver", 1002)
    assert silver.count() == 4 and load.layer(layers, "bronze", 1002).count() == 5
    full = sorted((tuple(r) for r in net_out(clean(silver.select(*fx.BILLING_COLUMNS))).collect()), key=str)
    assert table(layers, "gold", 1002) == full
    before = {name: table(layers, name, 1002) for name in load.RESET_ORDER if name != "bronze"}
    with pytest.raises(load.RunFailed, match="next batch is 1003"):
        load.run(spark, second, out, batch_id=1002, force=True)
    load.run(spark, second, out, batch_id=1002).collect()
    assert {name: table(layers, name, 1002) for name in before} == before
    assert spark.table("vw_sales_dashboard").count() == 3
    assert spark.table("vw_sales_by_billing_type").first().total_returns == 9


def test_default_runs_follow_each_other_and_load_files_once(spark, put, tmp_path):
    out = str(tmp_path / "out")
    layers = Layers(spark, out)
    one, two = put("one", "a.csv", FIRST), put("two", "b.csv", SECOND)
    for folder in (one, two, one, two):
        load.run(spark, folder, out).collect()
    assert layers.latest() == 1002
    assert load.layer(layers, "silver", 1002).count() == 4 and load.layer(layers, "bronze", 1002).count() == 5
    load.run(spark, two, out, force=True).collect()
    assert layers.latest() == 1003
    assert load.layer(layers, "silver", 1003).count() == 4 and load.layer(layers, "bronze", 1003).count() == 8
    with pytest.raises(load.RunFailed, match="older"):
        load.refresh(layers, load.layer(layers, "silver", 1002), 1002, 1001)


def test_streams_and_runs_share_a_root(spark, put, tmp_path):
    out = str(tmp_path / "out")
    load.run(spark, put("one", "a.csv", FIRST), out).collect()
    for name, text in (("two", SECOND), ("three", HEADER + "5,10,ZF2,03/14/1996,1,3,d,g,5\n")):
        folder = put(name, "b.csv", text)
        start_refresh(spark, csv_stream(spark, folder), out, str(tmp_path / f"marks-{name}")).awaitTermination()
    layers = Layers(spark, out)
    assert layers.latest() == 1003
    assert load.layer(layers, "silver", 1003).count() == 5 and load.layer(layers, "bronze", 1003).count() == 6


def test_bad_rows_are_kept_aside(spark, put, tmp_path):
    out = str(tmp_path / "out")
    folder = put("bad", "x.csv", FIRST + "x,10,ZF2,03/14/1996,1,3,d,g,5\n")
    report = {r.step: r.n_rows for r in load.run(spark, folder, out, on_error="quarantine").collect()}
    assert (report["bronze"], report["quarantine"]) == (2, 1)
    kept = Layers(spark, out).read("quarantine", 1001).first()
    assert (kept.billing_document, kept.reason, kept.source_file, kept.batch_id) == ("x", "billing_document", "x.csv", 1001)


def test_edits_flow_through(spark, put, tmp_path):
    out = str(tmp_path / "out")
    layers = Layers(spark, out)
    load.run(spark, put("one", "a.csv", FIRST), out).collect()
    load.edit(layers, F.col("billing_document") == 910000011, {"billing_qty_in_sku": F.lit(7).cast("bigint")})
    load.edit(layers, F.col("billing_document") == 910000012)
    for name in ("silver", "gold", "fact_sales"):
        rows = load.layer(layers, name, layers.latest()).select("billing_document", "billing_qty_in_sku").collect()
        assert [tuple(r) for r in rows] == [(910000011, 7)]


def test_no_new_rows_writes_nothing(spark, put, tmp_path):
    out = str(tmp_path / "out")
    report = load.run(spark, put("empty", "e.csv", HEADER), out).collect()
    assert [(r.step, r.status, r.message) for r in report] == [("bronze", "skipped", "no new rows")]
    assert not Layers(spark, out).has_buckets("silver", 1001)


def test_a_failed_step_stops_the_run(spark, put, tmp_path):
    bad = put("bad", "x.csv", HEADER + "x,10,ZF2,03/14/1996,1,3,d,g,5\n")
    report = load.run(spark, bad, str(tmp_path / "out")).collect()
    assert report[0].status == "failed" and {r.status for r in report[1:]} == {"skipped"}
    with pytest.raises(load.RunFailed):
        load.run(spark, bad, str(tmp_path / "out"), batch_id=1009)


def test_reset_reports_dropped_rows_and_errors(spark, put, tmp_path):
    out = str(tmp_path / "out")
    load.run(spark, put("one", "a.csv", FIRST), out).collect()
    layers = Layers(spark, out)
    report = load.reset_layers(layers, 1001, 1002, (*load.RESET_ORDER, "unknown")).collect()
    assert [(r.layer, r.rows_deleted) for r in report][:3] == [("fact_sales", 2), ("gold", 2), ("silver", 2)]
    assert report[-1].layer == "unknown" and report[-1].error
    for name in load.RESET_ORDER:
        assert load.layer(layers, name, 1002).count() == 0 and load.layer(layers, name, 1001).count() > 0
    load.run(spark, put("two", "b.csv", SECOND), out, batch_id=1003).collect()
    assert load.layer(layers, "silver", 1003).count() == 3 and load.layer(layers, "bronze", 1003).count() == 3


def test_stream_equals_batches(spark, put, tmp_path):
    inbox = put("in", "a.csv", FIRST)
    out, batch_out, marks = (str(tmp_path / name) for name in ("stream", "batch", "marks"))

    def drain():
        start_refresh(spark, csv_stream(spark, inbox), out, marks).awaitTermination()
        return Layers(spark, out).latest()

    assert drain() == 1001
    put("in", "b.csv", SECOND)
    assert drain() == 1002
    assert drain() == 1002
    load.run(spark, put("one", "a.csv", FIRST), batch_out).collect()
    load.run(spark, put("two", "b.csv", SECOND), batch_out, batch_id=1002).collect()
    streamed, batched = Layers(spark, out), Layers(spark, batch_out)
    assert not streamed.has_buckets("silver", 1003)
    for name in load.RESET_ORDER:
        if name != "bronze":
            assert table(streamed, name, 1002) == table(batched, name, 1002)


def test_only_touched_buckets_are_written_and_read(spark, put, tmp_path):
    out = str(tmp_path / "out")
    layers = Layers(spark, out)
    load.run(spark, put("one", "a.csv", FIRST), out).collect()
    load.run(spark, put("two", "b.csv", SECOND), out, batch_id=1002).collect()
    live = {row.bucket: row.v for row in layers.read("silver_in_64_live", 1002).collect()}
    assert set(live.values()) == {1001, 1002}
    untouched = layers.buckets_of(spark.createDataFrame([(910000012,)], "billing_document bigint"))
    assert live[untouched.first().bucket] == 1001
    part = layers.read_buckets("silver", 1002, load.BUCKETED["silver"], untouched)
    assert {row.billing_document for row in part.collect()} == {910000012}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_a_bucket_that_loses_all_rows_stays_empty(spark, lines, tmp_path):
    layers = Layers(spark, str(tmp_path / "out"))
    load.refresh(layers, lines((1, 10, "ZF2", 5), (2, 10, "ZF2", 6)), 1001, None)
    gone = lines((1, 10, "ZF2", 5)).selectExpr("*", "'DELETE' as _action", "false as _is_update", "1L as _seq")
    report = load.refresh(layers, gone, 1002, 1001)
    assert {row[2] for row in report} == {"done"}
    for name in ("silver", "gold", "fact_sales"):
        assert [row.billing_document for row in load.layer(layers, name, 1002).collect()] == [2]
        assert load.layer(layers, name, 1001).count() == 2


def line(document, qty=1, kind="ZF2", assigned=None, item=10):
    return f"{document},{item},{kind},03/14/1996,{qty},M-0417,Broiler,G01,{assigned or document}\n"


def documents(spark, out, name="silver"):
    layers = Layers(spark, out, 4)
    return sorted(r.billing_document for r in load.layer(layers, name, layers.latest()).collect())


def test_the_ledger_goes_by_content(spark, put, tmp_path):
    out, inbox = str(tmp_path / "out"), tmp_path / "in"
    put("in", "a [1] {x}.csv", HEADER + line(1))
    load.run(spark, str(inbox), out, buckets=4)
    put("in", "late.csv", HEADER + line(2))
    month_ago = time.time() - 30 * 86_400
    os.utime(inbox / "late.csv", (month_ago, month_ago))
    load.run(spark, str(inbox), out, buckets=4)
    assert documents(spark, out) == [1, 2]
    put("in", "late.csv", HEADER + line(3) + line(4))
    put("in", "copy.csv", HEADER + line(5))
    put("in", "twin.csv", HEADER + line(5))
    load.run(spark, str(inbox), out, buckets=4)
    assert documents(spark, out) == documents(spark, out, "bronze") == [1, 2, 3, 4, 5]
    (inbox / "late.csv").rename(inbox / "renamed.csv")
    os.utime(inbox / "copy.csv")
    for _ in range(2):
        report = load.run(spark, str(inbox), out, buckets=4).collect()
        assert [(r.status, r.message) for r in report] == [("skipped", "no new rows")]
    ledger = Layers(spark, out, 4).ledger()
    assert ledger.count() == 7 and ledger.select("digest").distinct().count() == 4
    assert Layers(spark, out, 4).latest() == 1003


def test_two_writers_at_once_are_refused(spark, put, tmp_path):
    out, inbox = str(tmp_path / "out"), put("in", "a.csv", HEADER + line(1))
    layers = Layers(spark, out, 4)
    layers.claim(1001, "someone else")
    with pytest.raises(Busy):
        load.run(spark, inbox, out, buckets=4)
    layers.claim(1001, "someone else")  # the same load may go on
    layers.release(1001)

    def attempt(_):
        try:
            return load.run(spark, inbox, out, buckets=4).first().status
        except Busy:
            return "busy"

    with ThreadPoolExecutor(2) as pool:
        found = sorted(pool.map(inheritable_thread_target(spark)(attempt), range(2)))
    assert found in (["busy", "done"], ["done", "skipped"])
    assert documents(spark, out, "bronze") == [1]


def test_a_watch_loads_replaced_files(spark, put, tmp_path):
    out, inbox = str(tmp_path / "out"), put("in", "a.csv", HEADER + line(1))
    query = start_watch(spark, inbox, out, str(tmp_path / "marks"), {"processingTime": "1 second"}, buckets=4)
    try:
        for n, text in enumerate((line(1), line(2), line(3))):
            put("in", "a.csv", HEADER + text)
            limit = time.time() + 240
            while (Layers(spark, out, 4).latest() or 0) < 1001 + n:
                assert time.time() < limit and query.exception() is None
                time.sleep(1)
    finally:
        query.stop()
    assert documents(spark, out) == [1, 2, 3]


def test_a_small_batch_opens_no_untouched_bucket(spark, lines, tmp_path):
    """What lies in other buckets of silver, gold, fact and returns is made unreadable before the small batch."""
    layers = Layers(spark, str(tmp_path / "out"), 16)
    first = [(n, 10, "ZF2", 50, {"assignment": n, "material": f"M{n % 7}"}) for n in range(200)]
    first += [(1_000 + n, 10, "ZRE", 1 + n, {"assignment": n, "material": f"M{n % 7}"}) for n in range(0, 200, 3)]
    load.refresh(layers, lines(*first), 1001, None)
    second = [(3, 20, "ZF2", 9, {"assignment": 3, "material": "M3"}), (1_003, 10, "ZRE", 4, {"assignment": 3, "material": "M3"})]
    second += [(2_000, 10, "S1", 5, {"assignment": 6, "material": "M6"})]
    feed = lines(*second).withColumns({"_action": F.lit("INSERT"), "_is_update": F.lit(True), "_seq": F.lit(1).cast("bigint")})
    named = spark.createDataFrame([(3,), (1_003,), (2_000,), (6,)], "billing_document bigint")
    touched = {r.bucket for r in layers.buckets_of(named).collect()}
    assert len(touched) < 8
    spoilt = 0
    for name in ("silver", "gold", "fact_sales", "returns"):
        for part in Path(layers.root, f"{name}_in_16", "v=1001").glob("bucket=*/*.parquet"):
            if int(part.parent.name.split("=")[1]) not in touched:
                part.write_bytes(b"not to be read")
                part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
                spoilt += 1
    report = load.refresh(layers, feed, 1002, 1001)
    assert {r[2] for r in report} == {"done"} and spoilt > 20
    gold = layers.written_rows("gold", 1002, load.BUCKETED["gold"]).filter("billing_document in (3, 6)")
    assert {(r.billing_document, r.item): (r.billing_qty_in_sku, r.return_qty) for r in gold.collect()} == {
        (3, 10): (50, 4), (3, 20): (9, 4), (6, 10): (50, 12),
    }
    assert load.layer(layers, "dim_product", 1002).count() == 7


def feed_of(lines, *rows):
    """Rows of (document, item, type, qty, action, is_update)."""
    made = lines(*(r[:4] for r in rows), assignment=7)
    marks = {(r[0], r[1], r[3]): r[4:] for r in rows}
    action = F.lit(None).cast("string")
    update = F.lit(None).cast("boolean")
    for (document, item, qty), (does, is_update) in marks.items():
        test = F.col("billing_document").eqNullSafe(F.lit(document)) & F.col("item").eqNullSafe(F.lit(item)) & (F.col("billing_qty_in_sku") == qty)
        action, update = F.when(test, does).otherwise(action), F.when(test, is_update).otherwise(update)
    return made.withColumns({"_action": action, "_is_update": update, "_seq": F.lit(1).cast("bigint")})


LOADS = [
    [(1, 10, "ZF2", 5, "INSERT", False), (2, 10, "ZF2", 6, "INSERT", False), (7, 10, "ZF2", 70, "INSERT", False), (None, 10, "ZRE", 3, "INSERT", False)],
    [(1, 10, "ZF2", 50, "INSERT", True), (2, 10, "ZF2", 6, "DELETE", False), (3, 10, "ZF2", 8, "INSERT", False), (7, None, "ZRE", 4, "INSERT", False)],
    [(1, 10, "ZF2", 51, "INSERT", False), (2, 10, "ZF2", 60, "INSERT", False), (3, 10, "ZF2", 80, "INSERT", True), (4, 10, "S1", 9, "INSERT", True)],
]


@pytest.mark.parametrize("gone", [0, 1, 2])
def test_a_batch_deleted_is_as_if_it_never_came(spark, lines, tmp_path, gone):
    whole, other = (Layers(spark, str(tmp_path / name), 4) for name in ("whole", "other"))
    for n, rows in enumerate(LOADS):
        load.refresh(whole, feed_of(lines, *rows), 1001 + n, 1000 + n if n else None)
    kept = [rows for n, rows in enumerate(LOADS) if n != gone]
    for n, rows in enumerate(kept):
        load.refresh(other, feed_of(lines, *rows), 1001 + n, 1000 + n if n else None)
    report = load.edit_batches(whole, [1001 + gone])
    assert {r[2] for r in report} == {"done"}
    for name in ("silver", "gold", "fact_sales"):
        assert table_of(whole, name) == table_of(other, name), name
    state = load.STATE["returns"]
    for at in (whole, other):
        at.kept_returns = sorted(tuple(r) for r in at.read_buckets("returns", at.latest(), state).drop(*STAMPS).select("billing_qty_in_sku", "assignment").collect())
    assert whole.kept_returns == other.kept_returns
    # Loads after it build on what is left.
    for at in (whole, other):
        load.refresh(at, feed_of(lines, (1, 10, "ZF2", 500, "INSERT", True), (9, 10, "ZRE", 1, "INSERT", False)), at.latest() + 1, at.latest())
    assert table_of(whole, "gold") == table_of(other, "gold")


def table_of(layers, name):
    return sorted((tuple(r) for r in load.layer(layers, name, layers.latest()).drop(*STAMPS).collect()), key=str)


def test_batches_are_edited_by_file_and_twice(spark, put, tmp_path):
    out = str(tmp_path / "out")
    put("in", "a.csv", HEADER + line(1, 5) + line(2, 6))
    load.run(spark, str(tmp_path / "in"), out, buckets=4)
    put("in", "b.csv", HEADER + line(3, 7) + line(4, 8))
    load.run(spark, str(tmp_path / "in"), out, buckets=4)
    layers = Layers(spark, out, 4)
    six_hundred = {"billing_qty_in_sku": F.lit(600).cast("bigint")}
    load.edit_batches(layers, source_files=["b.csv"], condition=F.col("billing_document") == 3, values=six_hundred)
    load.edit(layers, F.col("billing_document") == 4, {"billing_qty_in_sku": F.lit(1).cast("bigint")})
    load.edit_batches(layers, [1001], values=six_hundred)
    load.edit_batches(layers, source_files=["b.csv"], condition=F.col("billing_document") == 3)
    assert [(r.billing_document, r.billing_qty_in_sku) for r in load.layer(layers, "gold", layers.latest()).orderBy("billing_document").collect()] == [
        (1, 600), (2, 600), (4, 1),
    ]
    assert load.edit_batches(layers, [1001], condition=F.col("billing_document") == 99)[0][2] == "skipped"
    load.edit_batches(layers, source_files=["b.csv"])
    assert documents(spark, out) == [1, 2]


def test_replay_equals_merging_load_by_load(spark, lines):
    import random

    from ledgermill.operators.merge import DOCUMENT_LINE, merge_cdc

    rng = random.Random(6)
    feeds = []
    for _ in range(5):
        rows = {(rng.randrange(12), 10): (rng.randrange(1, 10_000), *rng.choice([("INSERT", False), ("INSERT", True), ("DELETE", False)])) for _ in range(8)}
        feeds.append(feed_of(lines, *((d, i, "ZF2", q, a, u) for (d, i), (q, a, u) in rows.items())))
    silver, history = lines(), None
    for n, feed in enumerate(feeds):
        silver = merge_cdc(silver, net_changes(feed, DOCUMENT_LINE), netted=True)
        part = feed.withColumns({"batch_id": F.lit(n), "source_file": F.lit("x")})
        history = part if history is None else history.unionByName(part)
    got = replayed(history, history.select(*DOCUMENT_LINE)).select("billing_document", "billing_qty_in_sku")
    want = silver.select("billing_document", "billing_qty_in_sku")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    edits = history.withColumn("source_file", F.lit(EDITED))
    assert replayed(edits, edits.select(*DOCUMENT_LINE)).count() == 0


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_any_order_of_the_same_loads_gives_the_same_layers(spark, lines, tmp_path, order):
    loads = [feed_of(lines, *rows).withColumn("_seq", F.lit(n + 1).cast("bigint")) for n, rows in enumerate(LOADS)]
    layers = Layers(spark, str(tmp_path / "out"), 4)
    for n, at in enumerate(order):
        report = load.refresh(layers, loads[at], 1001 + n, 1000 + n if n else None, ordered=True)
        assert {r[2] for r in report} == {"done"}, report
    rows = load.layer(layers, "silver", 1003).select("billing_document", "item", "billing_type", "billing_qty_in_sku").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(1, 10, "ZF2", 50), (2, 10, "ZF2", 60), (3, 10, "ZF2", 80), (4, 10, "S1", 9), (7, 10, "ZF2", 70), (7, None, "ZRE", 4), (None, 10, "ZRE", 3)],
        key=str,
    )
    gold = {r.billing_document: r.return_qty for r in load.layer(layers, "gold", 1003).collect()}
    assert gold == {1: 0, 2: 0, 3: 0, 7: 16}
    load.edit_batches(layers, [1001 + order.index(1)])
    rows = load.layer(layers, "silver", 1004).select("billing_document", "billing_qty_in_sku").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, 5), (2, 6), (3, 80), (4, 9), (7, 70), (None, 3)], key=str)


def test_order_is_kept_from_the_first_load_on_or_not_at_all(spark, lines, tmp_path):
    layers = Layers(spark, str(tmp_path / "out"), 4)
    load.refresh(layers, lines((1, 10, "ZF2", 5)), 1001, None)
    with pytest.raises(load.RunFailed, match="from the first load"):
        load.refresh(layers, lines((1, 10, "ZF2", 5)), 1002, 1001, ordered=True)


def test_tables_between_steps_go_once_a_version_is_finished(spark, lines, tmp_path):
    layers = Layers(spark, str(tmp_path / "out"), 4)
    load.refresh(layers, lines((1, 10, "ZF2", 5)), 1001, None)
    load.refresh(layers, lines((2, 10, "ZF2", 5)), 1002, 1001)
    assert {row[2] for row in load.edit(layers, F.col("item") == 10, {"material": F.lit("M1")})} == {"done"}
    assert not [place for name in ("changes", "images", "came") for place in (tmp_path / "out" / name).glob("v=*")]
    assert load.layer(layers, "fact_sales", 1003).filter("material = 'M1'").count() == 2


@pytest.mark.parametrize(("buckets", "n_files"), [(8, 3), (32, 1)])
def test_tasks_write_into_few_buckets_themselves(spark, lines, tmp_path, buckets, n_files):
    layers = Layers(spark, str(tmp_path / "out"), buckets)
    rows = lines(*((n, 10, "ZF2", 50) for n in range(600))).repartition(3)
    layers.write_buckets(rows, "kept", 1001, layers.every_bucket(), None)
    found = [len(list(part.glob("*.parquet"))) for part in Path(layers.root, f"kept_in_{buckets}", "v=1001").glob("bucket=*")]
    assert found == [n_files] * buckets
    assert layers.read_buckets("kept", 1001, "billing_document bigint").count() == 600


def test_a_load_of_new_lines_meets_no_old_line(spark, lines, tmp_path):
    """Lines that are not there yet are added without a join of whole old lines; the layers are those of one load."""
    first = [(n, 10, "ZF2", 50, {"assignment": n, "material": f"M{n % 7}"}) for n in range(40)]
    second = [(1_000 + n, 10, "ZRE", 1 + n, {"assignment": n, "material": f"M{n % 7}"}) for n in range(0, 40, 3)]
    second += [(None, 10, "ZRE", 1, {"assignment": 5, "material": "M5"}), (3, 10, "ZF2", 99, {"assignment": 3})]
    seen = []
    layers = Layers(spark, str(tmp_path / "two"), 8)
    drop, layers.drop = layers.drop, lambda name, version: seen.append((name, version))
    load.refresh(layers, lines(*first), 1001, None)
    load.refresh(layers, lines(*second), 1002, 1001)
    assert layers.read("found", 1002).count() == 1  # the line that came again
    for name, version in seen:
        drop(name, version)
    once = Layers(spark, str(tmp_path / "one"), 8)
    load.refresh(once, lines(*first, *second[:-1]), 1001, None)
    for name in ("silver", "gold", "fact_sales", "dim_product"):
        assert table(layers, name, 1002) == table(once, name, 1001), name


def test_new_lines_are_written_beside_those_there(spark, lines, tmp_path, monkeypatch):
    """A load of new documents writes its own rows only; the layers, also once edited, are those of one load."""
    loads = []
    for n, at in enumerate((range(400), range(400, 430))):
        loads.append([(i, 10, "ZF2", 50, {"assignment": i, "material": f"M{i % 7}", "item_description": f"pig {n}"}) for i in at])
        loads[n] += [(90_000 + i, 10, "ZRE", 1 + i % 9, {"assignment": i, "material": f"M{i % 7}", "item_description": f"pig {n}"}) for i in at[::3]]
    layers, once = (Layers(spark, str(tmp_path / name), 2) for name in ("parts", "one"))
    monkeypatch.setattr("ledgermill.sources.layers.GROW_FROM", 1)
    for n, rows in enumerate(loads):
        assert {r[2] for r in load.refresh(layers, lines(*rows), 1001 + n, 1000 + n if n else None)} == {"done"}
    expected = {"silver": 40, "returns": 10, "gold": 30, "fact_sales": 30}
    assert {name: layers.written_rows(name, 1002, (load.BUCKETED | load.STATE)[name]).count() for name in expected} == expected
    assert layers.can_grow("silver", 1002, layers.every_bucket())
    monkeypatch.setattr("ledgermill.sources.layers.MOST_PARTS", 2)
    assert not layers.can_grow("silver", 1002, layers.every_bucket())
    load.refresh(once, lines(*loads[0], *loads[1]), 1001, None)
    for at in (layers, once):
        assert {r[2] for r in load.edit(at, F.col("billing_document") % 10 == 1)} == {"done"}
    for name in (*load.BUCKETED, "dim_product", "dim_billing_type", "dim_date"):
        assert table(layers, name, 1003) == table(once, name, 1002), name

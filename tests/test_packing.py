from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from ledgermill.functions.rules import clean
from ledgermill.operators import netting
from ledgermill.plans import load
from ledgermill.sources.billing_csv import export_csv

HEADER = "BILLING_DOCUMENT,ITEM,BILLING_TYPE,BILLING_DATE,BILLING_QTY_IN_SKU,MATERIAL,ITEM_DESCRIPTION,MATERIAL_GROUP,ASSIGNMENT\n"
ROWS = "1,10,ZF2,03/14/1996,64,M-1,broiler,G01,1\n91,10,ZRE,03/15/1996,9,M-1,broiler,G01,1\n"


def test_packed_files_are_loaded_once_for_their_content(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "a.csv.gz").write_bytes(gzip.compress((HEADER + ROWS).encode()))
    (inbox / "same.csv").write_text(HEADER + ROWS)
    (inbox / "b.csv.gz").write_bytes(gzip.compress((HEADER + "2,10,ZF2,03/14/1996,8,M-1,broiler,G01,2\n").encode()))
    report = {row.step: (row.n_rows, row.status) for row in load.run(spark, str(inbox), out).collect()}
    assert report["bronze"] == (3, "done") and report["gold"] == (2, "done")
    assert load.run(spark, str(inbox), out).first().status == "skipped"


def test_packed_export_gives_files_that_tasks_can_share(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(load.read_text_rows.__globals__["PACKED_OPTIONS"], "maxRecordsPerFile", 100)
    rows = spark.range(0, 1000, numPartitions=1).select(*(F.col("id").cast("string").alias(n) for n in HEADER.strip().lower().split(",")))
    export_csv(rows, str(tmp_path / "in"), packed=True)
    assert len(list((tmp_path / "in").glob("*.csv.gz"))) == 10
    report = load.run(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()
    assert report[0].n_rows == 1000


@pytest.mark.parametrize("most_bits", [netting.MOST_BITS, netting._BITS])
def test_invoices_without_returns_are_not_joined(spark, lines, monkeypatch, most_bits):
    silver = clean(
        lines(
            *((n, 10, "ZF2", 100) for n in range(3000)),
            (0, 20, "ZF2", 5, {"item_description": None}),
            (None, 30, "ZF2", 7),
            *((10_000 + n, 10, "ZRE", 1, {"assignment": n * 3 % 1500}) for n in range(1000)),
            (20_000, 10, "S1", 2, {"assignment": 0, "item_description": None}),
            (20_001, 10, "S1", 2, {"assignment": None}),
        )
    )
    expected = sorted(netting.net_out(silver).collect(), key=str)
    monkeypatch.setattr(netting, "MANY_RETURNS", 1)
    monkeypatch.setattr(netting, "MOST_BITS", most_bits)
    kept = silver.localCheckpoint()
    invoices = kept.filter("billing_type = 'ZF2'")
    assert sorted(netting.net_out(invoices, returns=kept).collect(), key=str) == expected
    named, alone = netting._named_or_not(invoices, kept.filter("billing_type <> 'ZF2'"))
    assert named.filter("billing_document < 1500 and billing_document % 3 = 0 and item = 10").count() == 500
    assert named.count() + alone.count() == 3002 and alone.count() > 2000

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgermill.sources import deliveries
from ledgermill.sources.billing_csv import export_csv, read_billing_csv, split_defects

HEADER = (
    "BILLING_DOCUMENT,ITEM,BILLING_TYPE,BILLING_DATE,BILLING_QTY_IN_SKU,"
    "MATERIAL,ITEM_DESCRIPTION,MATERIAL_GROUP,ASSIGNMENT\n"
)
GOOD = (
    HEADER
    + '910000011,10,ZF2,03/14/1996,64,M-0417,"Broiler, ""coarse""",G01,910000011\n'
    + "910000077,10,ZRE,1/9/1996,9,M-0417,Broiler,G01,910000011\n"
)
DIRTY = HEADER + (
    "1,10,ZF2,13/45/2025,10.5,NULL,null,,1\n"
    "2,20,ZF2,03/14/1996,-10.5,340,x,g,2\n"
    "3,x,ZF2,03/14/1996,many,340,x,g,3\n"
)


@pytest.fixture
def inbox(tmp_path):
    def put(name: str, text: str) -> str:
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(text)
        return str(folder)

    return put


def test_columns_are_read_by_position_with_lineage(spark, inbox):
    good, bad = read_billing_csv(spark, inbox("a.csv", GOOD), batch_id=1007, as_of=F.lit("1996-03-15").cast("timestamp"))
    rows = {row.billing_document: row for row in good.collect()}
    assert rows[910000011].item_description == 'Broiler, "coarse"'
    assert rows[910000011].billing_date == date(1996, 3, 14)
    assert rows[910000077].billing_date == date(1996, 1, 9)
    assert rows[910000077].assignment == 910000011
    assert {row.source_file for row in rows.values()} == {"a.csv"}
    assert {row.batch_id for row in rows.values()} == {1007}
    assert {row.ingestion_timestamp.isoformat() for row in rows.values()} == {"1996-03-15T00:00:00"}
    assert bad.count() == 0


def test_null_tokens_rounding_and_bad_dates(spark, inbox):
    good, bad = read_billing_csv(spark, inbox("d.csv", DIRTY), on_error="quarantine")
    rows = {row.billing_document: row for row in good.collect()}
    assert set(rows) == {1, 2}
    assert rows[1].billing_date is None and rows[1].billing_qty_in_sku == 11
    assert (rows[1].material, rows[1].item_description, rows[1].material_group) == (None, None, None)
    assert rows[2].billing_qty_in_sku == -11
    assert [(row.reason, row.item, row.billing_qty_in_sku) for row in bad.collect()] == [
        ("item,billing_qty_in_sku", "x", "many")
    ]


def test_null_tokens_can_be_turned_off(spark, inbox):
    good, _ = read_billing_csv(spark, inbox("d.csv", DIRTY), on_error="skip", null_tokens=())
    assert good.filter("billing_document = 1").first().material == "NULL"


def test_abort_also_stops_a_count(spark, inbox):
    good, _ = read_billing_csv(spark, inbox("d.csv", DIRTY))
    assert good.schema["item"].dataType.simpleString() == "bigint"
    with pytest.raises(Exception, match="not a number"):
        good.count()
    with pytest.raises(ValueError):
        split_defects(good, "explode")


def test_only_new_files_are_loaded(spark, inbox):
    path = inbox("a.csv", GOOD)
    ledger = deliveries.empty_ledger(spark)
    files = deliveries.delivered_files(spark, path)
    assert read_billing_csv(spark, path, ledger=ledger)[0].count() == 2
    ledger = deliveries.record_files(ledger, files, 1001)
    assert read_billing_csv(spark, path, ledger=ledger)[0].count() == 0
    assert read_billing_csv(spark, path, ledger=ledger, force=True)[0].count() == 2
    inbox("b.csv", HEADER + "5,10,ZF2,03/14/1996,1,3,d,g,5\n")
    assert [row.billing_document for row in read_billing_csv(spark, path, ledger=ledger)[0].collect()] == [5]


def test_export_has_a_header_and_reads_back(spark, inbox, tmp_path):
    good, _ = read_billing_csv(spark, inbox("a.csv", GOOD))
    out = str(tmp_path / "out")
    text = good.withColumn("billing_date", F.date_format("billing_date", "MM/dd/yyyy"))
    export_csv(text.select(*[c for c in HEADER.strip().lower().split(",")]), out)
    again, _ = read_billing_csv(spark, out)
    columns = HEADER.strip().lower().split(",")
    assert sorted(again.select(*columns).collect()) == sorted(good.select(*columns).collect())


def test_a_delivery_of_one_type_is_split_into_files_of_one_name(spark, lines, tmp_path, small_partitions):
    from ledgermill.plans.catalogue import _as_text, _deliver_by_type

    one = lines((1, 10, "ZF2", 5), (1, 20, "ZRE", 2))
    many = one.crossJoin(spark.range(60_000).withColumn("noise", F.sha2(F.col("id").cast("string"), 256)))
    text = _as_text(many.withColumn("item_description", F.col("noise")))
    _deliver_by_type(spark, text, str(tmp_path / "in"))
    rows, _ = read_billing_csv(spark, f"{tmp_path}/in/*")
    found = {row.billing_type: row for row in rows.groupBy("billing_type").agg(F.count("*").alias("n"), F.collect_set("source_file").alias("names")).collect()}
    assert {kind: (row.n, row.names) for kind, row in found.items()} == {"ZF2": (60_000, ["ZF2.csv"]), "ZRE": (60_000, ["ZRE.csv"])}
    assert len(list((tmp_path / "in").glob("*/ZF2.csv"))) > 1

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgermill.operators import views
from ledgermill.plans import catalogue, kept, load
from ledgermill.sources.layers import Layers


def in_order(frame):
    return sorted((tuple(r) for r in frame.select(sorted(frame.columns)).collect()), key=str)


def rows(*documents, group="G01"):
    return [
        (n, 10, "ZF2", 50 + n, {"assignment": n, "material": f"M{n % 7}", "item_description": f"pig {n % 7}", "material_group": group})
        for n in documents
    ] + [(n, 20, "ZF2", 5, {"assignment": n, "material": f"M{n % 5}", "item_description": f"fish {n % 5}"}) for n in documents]


def test_kept_views_equal_full_ones_after_loads_and_edits(spark, lines, tmp_path):
    layers = Layers(spark, str(tmp_path / "out"), 8)
    load.refresh(layers, lines(*rows(*range(60))), 1001, None)
    kept.keep_labels(layers, 1001)
    # Products get another group by a later line, in buckets that do not change otherwise.
    later = lines(*rows(100, 101, group="G99")).withColumn("billing_date", F.lit("1999-01-01").cast("date"))
    load.refresh(layers, later, 1002, 1001)
    load.edit(layers, F.col("billing_document") == 7, {"billing_qty_in_sku": F.lit(1).cast("bigint")})
    load.edit(layers, F.col("billing_document") == 9)
    newest = layers.latest()
    fact = load.layer(layers, "fact_sales", newest)
    products, types, days = (layers.read(name, newest) for name in load.DIMENSIONS)
    for mine, full in (
        (kept.sales_by_billing_type(layers, newest), views.sales_by_billing_type(fact, types)),
        (kept.sales_by_product(layers, newest), views.sales_by_product(fact, products)),
        (kept.sales_by_date(layers, newest), views.sales_by_date(fact, days)),
    ):
        assert sorted(mine.columns) == sorted(full.columns) and in_order(mine) == in_order(full)
    groups = fact.join(products, "material").groupBy(F.col("material_group").alias("key")).agg(
        F.count_distinct("billing_document").alias("n_documents"), F.sum("final_qty").alias("net")
    )
    assert groups.count() == 2
    assert in_order(kept.sales(layers, newest).filter("by = 'material_group'").select("key", "n_documents", "net")) == in_order(groups)


def test_catching_up_opens_changed_buckets_only(spark, lines, tmp_path):
    layers = Layers(spark, str(tmp_path / "out"), 16)
    load.refresh(layers, lines(*rows(*range(200))), 1001, None)
    kept.keep_sales(layers, 1001)
    kept.kept_sketches(layers, 1001).count()
    load.refresh(layers, lines(*rows(500)), 1002, 1001)
    spoilt = 0
    for name in ("fact_sales", "silver"):
        for part in Path(layers.root, f"{name}_in_16", "v=1001").glob("bucket=*/*.parquet"):
            part.write_bytes(b"not to be read")
            part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
            spoilt += 1
    assert spoilt > 20
    kept.keep_sales(layers, 1002)
    found = layers.read_buckets("kept_sales", 1002, kept.SALES_SCHEMA).filter("by = 'all'").agg(F.sum("n_documents")).first()[0]
    assert found == 201
    figures = kept.approx_figures(layers, 1002, 0.5, 2).first()
    assert abs(figures.n_documents - 201) <= 10
    assert 5 <= figures.quantile <= 60 and len(figures.materials) == 2


@pytest.mark.parametrize("name", ["kept_views", "edited_layers"])
def test_a_failed_edit_is_no_result(spark, lines, monkeypatch, name):
    """The layers are then those from before the edit, whose figures are not what was asked for."""
    some = lines(*rows(*range(20)))
    monkeypatch.setattr(catalogue, "_lines_once", lambda *_: some)
    monkeypatch.setattr(catalogue.adapter, "billing_lines", lambda *_: some)
    for edit in ("edit", "edit_batches"):
        monkeypatch.setattr(load, edit, lambda *_, **__: [("bronze", 1, "done", ""), ("silver", None, "failed", "no room")])
    with pytest.raises(load.RunFailed, match="no room"):
        getattr(catalogue, name)(spark, "")


def test_loads_that_can_not_be_read_are_no_empty_layers(spark, lines, tmp_path, monkeypatch):
    layers = Layers(spark, str(tmp_path / "out"), 4)
    assert layers.latest() is None and not layers.has_buckets("silver", 1001)
    load.refresh(layers, lines(*rows(1, 2)), 1001, None)
    monkeypatch.setattr("ledgermill.sources.layers.LOAD_SCHEMA", "version number")
    for call in (layers.latest, lambda: load.next_version(layers)):
        with pytest.raises(AnalysisException):
            call()


def test_nothing_sold(spark, lines, tmp_path):
    layers = Layers(spark, str(tmp_path / "out"), 4)
    load.refresh(layers, lines((1, 10, "S1", 5)), 1001, None)
    assert kept.sales(layers, 1001).count() == 0
    load.reset_layers(layers, 1001, 1002)
    assert kept.sales(layers, 1002).count() == 0
    assert kept.approx_figures(layers, 1002).first().n_documents == 0


def test_materials_that_a_sketch_can_not_tell_apart_are_counted(spark, lines, tmp_path, monkeypatch):
    monkeypatch.setattr(kept, "TRACKED", 8)
    layers = Layers(spark, str(tmp_path / "out"), 4)
    many = [(n, 10, "ZF2", 5, {"material": f"M{n % 100:03}"}) for n in range(300)]
    most = [(1000 + n, 10, "ZF2", 5, {"material": "M007"}) for n in range(2)]
    load.refresh(layers, lines(*many, *most, (2000, 10, "ZF2", 5, {"material": None})), 1001, None)
    materials = kept.approx_figures(layers, 1001, 0.5, 2).first().materials
    assert [tuple(one) for one in materials] == [("M007", 5), ("M000", 3)]
    found = views.top_k(lines(*many, *most), "material", 2, exact=False, tracked=8)
    assert [tuple(row) for row in found.collect()] == [("M007", 5), ("M000", 3)]

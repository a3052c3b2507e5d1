from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgermill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ledgermill-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


LINE_SCHEMA = (
    "billing_document bigint, item bigint, billing_type string, billing_date date, "
    "billing_qty_in_sku bigint, material string, item_description string, "
    "material_group string, assignment bigint"
)


@pytest.fixture
def lines(spark):
    """Build billing lines from (document, item, type, qty) with optional other fields."""
    from datetime import date

    def build(*rows, **defaults):
        made = []
        for row in rows:
            fields = {
                "billing_document": None,
                "item": None,
                "billing_type": None,
                "billing_date": date(1996, 3, 14),
                "billing_qty_in_sku": None,
                "material": "M-0417",
                "item_description": "broiler pellets",
                "material_group": "G01",
                "assignment": None,
            }
            names = ("billing_document", "item", "billing_type", "billing_qty_in_sku")
            fields.update(defaults)
            if isinstance(row, dict):
                fields.update(row)
            else:
                fields.update(zip(names, row[:4]))
                if len(row) > 4:
                    fields.update(row[4])
            made.append(tuple(fields[name.split()[0]] for name in LINE_SCHEMA.split(", ")))
        return spark.createDataFrame(made, LINE_SCHEMA)

    return build


@pytest.fixture
def small_partitions(spark):
    """Adaptive execution with thresholds small enough for test data, and no broadcasts."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)

from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns that operators name too."""

    def build(*rows):
        schema = (
            "doc_id bigint, text string, source string, size bigint, component_id string, n_words string, _copy_of string"
        )
        made = [(*r, None)[:3] + (7, "x", "y", "z") for r in rows]
        return spark.createDataFrame(made, schema)

    return build

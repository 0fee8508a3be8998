from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text[, lang[, source]]) as documents."""

    def make(*rows):
        full = [(*r, *(None,) * (4 - len(r)))[:4] for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)

    return make


@pytest.fixture(autouse=True)
def compiled(spark):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")

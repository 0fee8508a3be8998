"""Every registered query against its SQL on the smallest scale."""

from __future__ import annotations

import pathlib

import pytest

import __spark_entry__ as entry
from tests.check_queries import compare, connect
from tidemark.plans.catalog import CATALOG
from tidemark.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: entry.queries()[name] for name in CATALOG}

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 749


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR) is None

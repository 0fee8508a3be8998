from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=2)
    # Compiling wide plans costs more than these few rows; test_queries turns it on.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture
def small_chunks(spark):
    """Treat groups of more than a few rows as too large for one task."""
    spark.conf.set("tidemark.running.targetRows", "3")
    yield
    spark.conf.unset("tidemark.running.targetRows")


@pytest.fixture
def no_broadcast(spark):
    """Make every lookup table count as too large to broadcast."""
    spark.conf.set("tidemark.broadcast.maxRows", "0")
    yield
    spark.conf.unset("tidemark.broadcast.maxRows")

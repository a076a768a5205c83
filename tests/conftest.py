from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tablewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tablewright-tests")
    yield session
    session.stop()


@pytest.fixture
def many_chunks(spark):
    """Small partitions stay apart, so that groups span several chunks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"

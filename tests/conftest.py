from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablekit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        "4g",
        **{"spark.sql.shuffle.partitions": "2", "spark.sql.warehouse.dir": f"{root}/warehouse", "spark.checkpoint.dir": f"{root}/shared"},
    )
    yield session
    session.stop()


@pytest.fixture
def cut_small(spark):
    """Cut every key above 20 rows, so small tables exercise the slices."""
    spark.conf.set("tablekit.rowsPerSlice", "20")
    yield
    spark.conf.unset("tablekit.rowsPerSlice")

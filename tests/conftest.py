"""One Spark session and one DuckDB connection for all tests."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tradewind.session import build_session  # noqa: E402

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session("tests", "local[4]", **{
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(warehouse),
        "spark.sql.catalogImplementation": "in-memory",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample() -> str:
    return SAMPLE


@pytest.fixture(scope="session")
def star(spark, sample):
    from tradewind.plans.sample_star import SampleStar

    return SampleStar(spark, sample).star()


@pytest.fixture()
def as_of():
    from pyspark.sql import functions as F

    return F.lit("2001-08-01").cast("date")


def rows_of(frame, *keys):
    """Rows as dictionaries, sorted by the given columns."""
    found = [r.asDict() for r in frame.collect()]
    return sorted(found, key=lambda r: tuple(str(r[k]) for k in keys)) if keys else found

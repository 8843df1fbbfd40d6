"""One Spark session for all tests."""

from __future__ import annotations

import pytest

from lakeops.operators import windows
from lakeops.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("lakeops-tests", cores=4, memory="4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture()
def many_slices(spark):
    """Keep every shuffle partition, so that small data still spans several slices."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    every, per_slice, windows.SAMPLE_EVERY, windows.SAMPLE_PER_SLICE = windows.SAMPLE_EVERY, windows.SAMPLE_PER_SLICE, 2, 10
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield spark
    windows.SAMPLE_EVERY, windows.SAMPLE_PER_SLICE = every, per_slice
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    spark.conf.set("spark.sql.shuffle.partitions", "4")

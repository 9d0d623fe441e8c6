from __future__ import annotations

import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session


@pytest.fixture
def many_buckets(monkeypatch):
    """Small inputs get as many buckets as large ones."""
    monkeypatch.setattr("lanewise.operators.ordering.ROWS_PER_BUCKET", 1)


@pytest.fixture
def nothing_small(spark):
    """No side counts as small: every join shuffles."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)

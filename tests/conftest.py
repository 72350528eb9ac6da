from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableloom.session import local_session, scratch_database  # noqa: E402
from tableloom.plans.publish import Publisher  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def pub(spark):
    return Publisher(spark, scratch_database(spark, "test"))


def rows(df, *order):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

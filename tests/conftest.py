import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loadbay.session import local_session

    s = local_session("*", shuffle_partitions=8, app="loadbay-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="loadbay-test-", dir="/tmp")


@pytest.fixture(scope="module", autouse=True)
def no_frames_left_cached():
    """A module's cached frames end with it: others look for persisted data."""
    yield
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    if session:
        session.catalog.clearCache()

import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fanwrite.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, app="fanwrite-tests")
    session.sparkContext.environment["PYTHONPATH"] = REPO  # for the workers, whatever folder the tests run in
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture()
def scratch(spark, tmp_path):
    """A fresh folder per test (tests own their temp space)."""
    return str(tmp_path)

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from checks.run import session

    return session()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(sf_dir):
    from checks.compare import connect

    return connect(sf_dir)


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    from checks import standins

    return standins.tables(spark, sf_dir)

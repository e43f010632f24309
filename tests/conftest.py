from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from staylake.session import local_session

    session = local_session("*", shuffle_partitions=8, app="staylake-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lookups(spark):
    from staylake.plans.queries import fixture_lookups

    return fixture_lookups(spark, SF_SMALL)


@pytest.fixture()
def scratch(spark):
    """A fresh folder below the session's shared scratch area."""
    from staylake.session import scratch_path

    return scratch_path(spark, "test")

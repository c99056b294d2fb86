from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopstar.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="shopstar-tests")
    yield s


@pytest.fixture(scope="session")
def small_warehouse(spark):
    from shopstar.plans.warehouse import warehouse
    return warehouse(spark, SF_SMALL)

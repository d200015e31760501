import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from terrace.session import build_session

    session = build_session("local[4]", shuffle_partitions=8, app_name="terrace-tests")
    yield session


@pytest.fixture
def tmp_table(spark):
    from terrace.session import scratch_path

    return scratch_path(spark, "test")

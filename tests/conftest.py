import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from innlake.session import local_session

    session = local_session("8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("provided tables are not here")
    return SMALL


@pytest.fixture()
def rows(spark):
    """Build a frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from grainhouse.plans.warehouse import close_driver_warehouses, open_driver_warehouse  # noqa: E402
from grainhouse.session import local_session  # noqa: E402
from grainhouse.sources.store import Store  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", app="tests")
    yield session
    close_driver_warehouses(session)
    session.stop()


@pytest.fixture(scope="session")
def warehouse(spark):
    return open_driver_warehouse(spark, SMALL)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


@pytest.fixture
def frame(spark):
    """Build a small frame from rows and a schema text."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

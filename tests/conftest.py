import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobledger.plans.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "6g", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows(data, schema)`` as a DataFrame."""
    return lambda data, schema: spark.createDataFrame(data, schema)

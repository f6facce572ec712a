import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="*", shuffle_partitions=8, app="strata-tests")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Build a (path, body) document frame from JSON strings."""
    def make(*bodies):
        return spark.createDataFrame([(f"doc{i}", b) for i, b in enumerate(bodies)], "path string, body string")
    return make

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def split_all(spark):
    """Treat every input as large, so hot groups are cut into chunks."""
    spark.conf.set("spark.millrace.split.smallBytes", "0")
    yield
    spark.conf.unset("spark.millrace.split.smallBytes")

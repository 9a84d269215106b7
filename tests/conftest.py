import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlake.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="marketlake-tests", shuffle_partitions=8)
    yield s


@pytest.fixture
def frames(spark):
    """Build a frames DataFrame ``(frame_no, body)`` from literal texts."""
    def make(*bodies):
        return spark.createDataFrame(list(enumerate(bodies)), "frame_no bigint, body string")
    return make

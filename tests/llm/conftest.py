import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import edge  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return edge.edge_docs(spark).cache()


@pytest.fixture(scope="session")
def none(spark):
    return edge.empty_docs(spark)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hypeline.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", 8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def scratch(spark):
    from hypeline.session import scratch_path
    return lambda name="t": scratch_path(spark, name)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayledger.session import local_session, scratch_path  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, "stayledger-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    return lambda name="t": scratch_path(spark, name)

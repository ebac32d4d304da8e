import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rivulet.session import get_session  # noqa: E402

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", "rivulet-tests", shuffle_partitions=4, driver_memory="8g")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="rivulet-test-", dir="/tmp")


def fixture_path(name: str) -> str:
    return os.path.join(FIXTURES, name)

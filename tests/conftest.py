import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tanimart.session import local_session
    os.environ.setdefault("TANIMART_DRIVER_MEMORY", "4g")
    s = local_session("*", shuffle_partitions=8, app="tanimart-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="tanimart-test-")

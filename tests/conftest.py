import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from crashlake.session import local_session
    s = local_session(4, shuffle_partitions=8, app="crashlake-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never cleared: a new one each time)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")

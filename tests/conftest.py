import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from portflow.session import build_session, checkpoint_root
    s = build_session("local[4]", shuffle_partitions=4, app_name="portflow-tests")
    # tests set their own checkpoint folder only when the session has none
    checkpoint_root(s, fallback=tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")

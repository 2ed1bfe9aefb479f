import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from meterwise.session import checkpoint_dir, get_session
    s = get_session("local[4]", 8, app_name="meterwise-tests", driver_memory="4g")
    checkpoint_dir(s, tempfile.mkdtemp(prefix="mw-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def out(tmp_path):
    return str(tmp_path)

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from farelane.session import build_session
    s = build_session("local[*]", 8, app_name="farelane-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="farelane-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="farelane-test-")

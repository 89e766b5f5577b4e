import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from capset.session import build_session

    s = build_session("local[4]", 4, app="capset-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="capset-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="capset-test-")

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from twosample.session import checkpoint_dir, local_session
    s = local_session("*", shuffle_partitions=8, app="twosample-tests")
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="twosample-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tmpdir_session():
    return tempfile.mkdtemp(prefix="twosample-tests-")

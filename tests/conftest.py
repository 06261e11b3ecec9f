import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rankforge.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rankforge-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"

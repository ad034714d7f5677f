import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickrisk.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tickrisk-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=4,
                      spark__checkpoint__dir=ckpt,
                      spark__ui__showConsoleProgress="false")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()

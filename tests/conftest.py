import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from audix.session import build_session, checkpoint_dir
    s = build_session("local[*]", app="audix-tests", shuffle_partitions=8)
    # Tests name their own checkpoint folder (no cluster setting here).
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="audix-test-ckpt-"))
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="audix-test-out-")

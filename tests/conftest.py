import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="strata-tests")
    # Tests run without a cluster: the shared folder is unset, so give one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from strata.session import scratch_path
    return scratch_path(spark, "test")

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from livetable.session import build_session
    s = build_session(master="local[8]", app="livetable-tests", shuffle_partitions=8,
                      checkpoint_dir=tempfile.mkdtemp(prefix="lt-test-ckpt-", dir="/tmp"),
                      # test_scale counts a query's executions, of which Spark keeps 1,000 by default.
                      extra={"spark.sql.ui.retainedExecutions": "10000"})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from logsmith.session import build_session
    # spark.checkpoint.dir comes from the environment's defaults when set; the
    # library only creates a temporary one when it is unset
    s = build_session("local[4]", app_name="logsmith-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="logsmith-test-")

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="millrace-tests", shuffle_partitions=8)
    # Tests own their session, so they may pick the shared folder when unset.
    if not s.conf.get("spark.checkpoint.dir", None):
        root = tempfile.mkdtemp(prefix="millrace-tests-")
        s.conf.set("spark.checkpoint.dir", root)
        s.sparkContext.setCheckpointDir(root)
    yield s
    s.stop()


@pytest.fixture
def workdir():
    return tempfile.mkdtemp(prefix="millrace-t-")

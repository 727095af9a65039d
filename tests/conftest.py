import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from textlens.session import build_session
    s = build_session("local[4]", app="textlens-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textlens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_folder():
    return tempfile.mkdtemp(prefix="textlens-test-")

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tally.session import build_session, checkpoint_dir

    s = build_session(master="local[*]", shuffle_partitions=8, app_name="tally-tests",
                      extra={"spark.ui.showConsoleProgress": "false"})
    # tests run locally: the checkpoint folder is only set because it is unset
    checkpoint_dir(s, tempfile.mkdtemp(prefix="tally-tests-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="tally-test-")

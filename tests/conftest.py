import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from setlist.session import build_session, checkpoint_dir

    s = build_session("local[4]", app="setlist-tests", shuffle_partitions=4)
    checkpoint_dir(s)  # sets one only if the session names none
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="setlist-test-")

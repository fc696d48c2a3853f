import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from farpoint.session import ensure_checkpoint_dir, local_session
    s = local_session("*", shuffle_partitions=8, app="farpoint-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def have_testdata():
    return os.path.isdir(SF_SMALL)

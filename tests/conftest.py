import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from saletrace.session import build_session, ensure_checkpoint_dir

    s = build_session("local[4]", app="saletrace-tests", shuffle_partitions=8)
    # the tests' own checkpoint folder, only because the session names none
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("driver test data not present")
    return SF_SMALL

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cohortlab.session import get_session, shared_dir
    s = get_session(master="local[*]", shuffle_partitions=8)
    shared_dir(s)  # tests set their own checkpoint folder (none is configured)
    yield s
    s.stop()

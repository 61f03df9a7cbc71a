import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kinloom.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="kinloom-tests")
    yield s
    s.stop()

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ratecell.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="ratecell-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from ratecell.verify import duck_connect
    return duck_connect(SF0001)

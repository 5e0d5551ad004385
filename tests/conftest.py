import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session(app="strata-tests", cpus=4, shuffle_partitions=4)
    yield s
    s.stop()

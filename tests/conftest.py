import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from flowsieve.session import build_session

    session = build_session("local[8]", "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from parlance.session import get_session
    s = get_session("local[*]", 8)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SMALL

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quernstone.session import local_session

    return local_session(8)


@pytest.fixture(scope="session")
def small():
    return SMALL

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tagspark.session import local_session

    return local_session(8)


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture(scope="session")
def con(folder):
    from check import oracle

    return oracle(folder)

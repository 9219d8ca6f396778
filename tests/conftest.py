import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from textloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "textloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF

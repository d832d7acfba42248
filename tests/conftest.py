import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablewright.session import build_session, shared_dir  # noqa: E402
from tests.compare import LOCAL  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", **LOCAL)
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF

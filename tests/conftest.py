import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shiftlode.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(app_name="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")

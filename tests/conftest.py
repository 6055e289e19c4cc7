import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from quern.session import local_session, prepare  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = prepare(local_session("4", 4))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF

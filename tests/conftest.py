import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from heronlake.session import build_session, clear_scratch, prepare  # noqa: E402
from tests.oracle import connect  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = prepare(build_session("local[8]", 8, "heronlake-tests"))
    yield session
    clear_scratch(session)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def con():
    return connect(SF_DIR)

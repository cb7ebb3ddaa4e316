import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tillstream.session import local_session, work_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path


@pytest.fixture
def folder(spark):
    return work_dir(spark, "test")

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeloom.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture
def scratch(spark):
    from lakeloom.session import scratch_path

    return lambda label="test": scratch_path(spark, label)

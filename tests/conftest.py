import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemason.session import local_session  # noqa: E402

DATA = os.environ.get("LAKEMASON_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.001"

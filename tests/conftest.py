import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from isobar.session import reachable, session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    reachable(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return os.environ.get("ISOBAR_TESTDATA", "/root/testdata/sf0.001")

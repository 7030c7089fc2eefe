import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from earshot.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "earshot-tests", "local[8]",
        spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"

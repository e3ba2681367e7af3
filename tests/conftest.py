import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayfleet.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__maxMetadataStringLength="2000",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="run-warehouse-"),
        spark__sql__catalogImplementation="in-memory",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

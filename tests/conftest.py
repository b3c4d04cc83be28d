import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from crawlspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TZ", "UTC")
    session = build_session(
        app="tests",
        master="local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="4g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")

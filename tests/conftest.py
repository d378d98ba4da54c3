import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from cohortry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="warehouse-", dir="/tmp"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def frame(spark):
    """Small typed frames from rows."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from harness.check import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="ledger-tests-")
    session = local_session(4, **{
        "spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": "4",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="ledger-case-")

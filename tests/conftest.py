import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# Python workers (UDF-free here, but foreach callbacks) import from both.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH", "")])

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def scratch():
    """A fresh folder for this test run (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="ledgerlens-test-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    from ledgerlens.session import build_session

    session = build_session(
        master="local[8]",
        app="ledgerlens-tests",
        shuffle_partitions=8,
        conf={
            "spark.ui.showConsoleProgress": "false",
            # Tests own their checkpoint folder; on a cluster it is given.
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
            "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

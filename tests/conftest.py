import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from sievework.session import local_session

    session = local_session("tests", cores="4", partitions=4, memory="3g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

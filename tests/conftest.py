import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from loomgraph.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "tests", shuffle_partitions=4, spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

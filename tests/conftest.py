import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from tradeflow.session import build_session  # noqa: E402

SMALL_SF = "/root/testdata/sf0.001"
CHECK_SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=8)
    yield session
    session.stop()

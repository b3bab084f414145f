import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shelfwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app_name="shelfwise-tests", shuffle_partitions=8)
    yield s
    s.stop()

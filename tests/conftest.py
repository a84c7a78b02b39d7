from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cadenza.session import local_session

    s = local_session("*", shuffle_partitions=8, app="cadenza-tests")
    yield s
    s.stop()

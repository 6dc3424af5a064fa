from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from role_frames import role_frame  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from demandlens.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="demandlens-test-")


@pytest.fixture()
def frame(spark):
    return lambda role, rows: role_frame(spark, role, rows)

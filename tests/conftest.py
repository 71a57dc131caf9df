from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from revlens.session import local_session

    session = local_session(
        4,
        shuffle_partitions=4,
        app_name="revlens-tests",
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="revlens-test-ckpt-")},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("test data not available")
    return SMALL

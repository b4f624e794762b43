from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from daybook.session import build_session, checkpoint_dir

    session = build_session("local[*]", app_name="daybook-tests", shuffle_partitions=8)
    checkpoint_dir(session)
    yield session


@pytest.fixture()
def scratch(spark):
    """A fresh folder below the session's shared checkpoint folder."""
    from daybook.session import scratch_location

    def make(label: str = "t") -> str:
        return scratch_location(spark, label)

    return make

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapledger.session import build_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    settings = {"spark__sql__shuffle__partitions": "8", "spark__driver__memory": "4g"}
    session = build_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return TABLES


def rows(df, *order):
    """All rows as tuples in a fixed order."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=repr)

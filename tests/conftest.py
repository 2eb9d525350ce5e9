from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"
CHECK_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chainfold.session import build_session

    s = build_session(master=os.environ.get("CHAINFOLD_TEST_MASTER", "local[*]"), shuffle_partitions=8, app_name="chainfold-tests")
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as sorted tuples (for order-insensitive asserts)."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=repr)

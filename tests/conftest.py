import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loadwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, app_name="loadwright-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples, NULLs first, for order-free comparison."""
    cols = cols or df.columns
    key = lambda t: tuple((v is not None, v) for v in t)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martspark import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", 8, app_name="martspark-tests")
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="martspark-test-", dir="/tmp")


def rows(df, *cols):
    """Sorted list of tuples for order-insensitive assertions."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple(str(x) for x in t))

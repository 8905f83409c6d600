import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kabuto.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="kabuto-tests")
    yield s
    s.stop()


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def rows(df, *cols):
    """Collect as sorted tuples (NULLs first) for order-insensitive assertions."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))

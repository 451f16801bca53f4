import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from umbral.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", "umbral-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def rows():
    """rows(df, *cols): sorted tuples, NULLs first."""
    def collect(df, *cols):
        out = [tuple(r[c] for c in (cols or df.columns)) for r in df.collect()]
        return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))
    return collect

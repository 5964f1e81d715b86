import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app_name="strata-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield s


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols, key=None):
    """Collect ``cols`` (default all) as sorted tuples."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=key or (lambda t: tuple((x is None, str(x)) for x in t)))

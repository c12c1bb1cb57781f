import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from arearisk.session import get_session
    s = get_session("local[4]", 8, app_name="arearisk-tests")
    # tests only: a private checkpoint folder (clusters name a shared one)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="arearisk-test-ckpt-"))
    yield s
    from arearisk.session import drop_scratch

    drop_scratch(s)
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given (or all) columns."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sluice.session import build_session

    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    # a fresh folder per test (never reused, never cleared)
    return tempfile.mkdtemp(prefix="sluice-test-")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pitspark.session import local_session

    s = local_session(4, shuffle_partitions=4, app="pitspark-tests", checkpoints=tempfile.mkdtemp(prefix="pitspark-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Collect a (small, test-sized) frame as sorted tuples."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is not None, v) for v in t))

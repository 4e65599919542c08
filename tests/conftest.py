import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="tidepool-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as sorted list of tuples (order-free comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=_sort_key)


def _sort_key(t):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)

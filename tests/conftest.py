import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seasonlab.session import build_session, use_local_scratch  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="seasonlab-tests", shuffle_partitions=8)
    use_local_scratch(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(f"{SF_SMALL}/orders.parquet"):
        pytest.skip("test tables not available")
    return SF_SMALL


def rows(df, *cols):
    """Collect selected columns as a sorted list of tuples."""
    return sorted(tuple(r) for r in df.select(*cols).collect())

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="strata-tests", shuffle_partitions=4)
    checkpoint_dir(s)  # sets a private folder only when the session has none
    yield s


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset), sorted for comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from liftspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def small_cells(monkeypatch):
    """Plan cells of a few rows, so that small frames take the paths of large ones."""
    from liftspark.operators import prefix

    monkeypatch.setattr(prefix, "ROWS_PER_CELL", 7)

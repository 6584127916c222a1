import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from sitelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a result as sorted tuples of some columns."""

    def collect(df, *columns):
        found = df.select(*columns).collect() if columns else df.collect()
        return sorted((tuple(row) for row in found), key=lambda row: [repr(v) for v in row])

    return collect

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from rankmart.session import local_session

    session = local_session(8, "rankmart tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples; NULL sorts first."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in chosen.collect()),
            key=lambda r: [(v is not None, str(v)) for v in r],
        )

    return collect

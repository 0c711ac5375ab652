import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tallyweave.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", cpus=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted tuples of a frame, NULL first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, v) for v in r))

    return collect

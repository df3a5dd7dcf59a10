import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from periodica.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(4, 4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a DataFrame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from devigil.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "tests", 4, **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"}
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted plain tuples of a frame."""

    def collect(df, *columns):
        out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(out, key=repr)

    return collect

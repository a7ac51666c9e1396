import os
from pathlib import Path

import pytest

from trackmill.session import build_session

# Made-up sample files.
DATA = Path(__file__).parent / "data"
TABLES = os.environ.get("TRACKMILL_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: [(v is not None, str(type(v)), v) for v in r])

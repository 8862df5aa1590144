import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from furrow.session import local_session  # noqa: E402

TESTDATA = os.environ.get("FURROW_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        8, "furrow-tests", spark__sql__maxMetadataStringLength="2000",
        spark__checkpoint__dir=f"file://{folder}", spark__sql__warehouse__dir=f"file://{folder}/warehouse",
    )
    yield session
    session.stop()


@pytest.fixture
def sf():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples; NULL sorts first."""

    def collect(df, *columns):
        picked = df.select(*(f"`{c}`" for c in columns)) if columns else df
        key = lambda row: [(value is not None, str(type(value)), value) for value in row]
        return sorted((tuple(row) for row in picked.collect()), key=key)

    return collect

from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loanops.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """``make("a long, b string", rows)``: a small table; naive datetimes become zoneless timestamps."""

    def build(schema, rows):
        return spark.createDataFrame([tuple(r) for r in rows], schema.replace("ts", "timestamp_ntz"))

    return build


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows_of(frame):
    """Rows as tuples, sorted, nulls included."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)

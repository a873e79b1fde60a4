"""Shared session and small helpers."""

from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from powerflow.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=2)
    # a few rows per query: compiling each plan would take longer than running it
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame from tuples and DDL."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    picked = df.select(*cols) if cols else df
    return sorted(
        (tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r]
    )

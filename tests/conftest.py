from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortline.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, memory="6g", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(autouse=True)
def no_leftovers():
    """What a test cached does not show in the plans of the next one."""
    yield
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()


@pytest.fixture(scope="session")
def folder():
    return SMALL


def plan_of(df) -> str:
    """Physical plan text, as ``explain`` prints it."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]

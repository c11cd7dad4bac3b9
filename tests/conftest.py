from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

SMALL_DIR = "/root/testdata/sf0.001"
ORACLE_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cohortkit.session import build_session

    session = build_session(master="local[4]", app_name="cohortkit-tests", shuffle_partitions=8, driver_memory="4g")
    yield session
    session.stop()


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none given)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def plan_text(df) -> str:
    """The physical plan as ``df.explain()`` prints it (the final adaptive
    plan once the DataFrame has run)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()

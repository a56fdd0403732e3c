from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratalake.plans.jobs import Layers  # noqa: E402
from stratalake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def layers(tmp_path):
    tag = uuid.uuid4().hex[:8]
    return Layers(f"silver_{tag}", f"gold_{tag}", f"ops_{tag}", location=str(tmp_path))


def rows(df, *columns):
    """Sorted tuples of a small result."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

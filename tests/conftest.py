import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from layerflow.session import build_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def ws(spark):
    """A fresh schema + folder below the shared root."""
    from layerflow.plans.suite import Workspace
    return Workspace(spark, "/root/testdata/sf0.001")


@pytest.fixture
def folder(spark):
    return scratch_dir(spark, "test")

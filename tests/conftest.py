from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tidemark.plans.tables import TargetStore  # noqa: E402
from shown import SF_DIR  # noqa: E402
from tidemark.session import clear_scratch, local_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session("8", shuffle_partitions=4, **{"spark.sql.warehouse.dir": warehouse})
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def store(spark):
    return TargetStore(spark, scratch_dir(spark, "test"))


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR

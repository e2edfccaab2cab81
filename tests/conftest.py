from __future__ import annotations

import pytest

from yearring.session import local_session
from yearring.sources.store import ArchiveStore

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # A zone with daylight saving: nothing may depend on the session zone.
    session = local_session(8, "tests", **{"spark.sql.session.timeZone": "America/New_York", "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return ArchiveStore(spark, str(tmp_path / "archives"))


@pytest.fixture(scope="session")
def sf():
    return SF

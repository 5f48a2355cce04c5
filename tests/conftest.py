"""One local session for all tests."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pytest
from pyspark.sql import SparkSession

from tallyloom.session import local_session


@pytest.fixture(scope="session")
def spark() -> Iterator[SparkSession]:
    session = local_session("4", partitions=4, memory="4g", **{"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from skyops.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, **{"spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def zone(spark):
    """Sets the session time zone for one test."""
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)

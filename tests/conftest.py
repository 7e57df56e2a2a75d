import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog.schema import LOG_SCHEMA  # noqa: E402
from tidelog.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_log(spark):
    """Records given as (partition, offset[, key, value, headers, timestamp]) on topic ``orders``."""
    def build(rows, topic="orders"):
        full = []
        for row in rows:
            partition, offset, key, value, headers, moment = (*row, *[None] * 6)[:6]
            as_bytes = [x.encode() if isinstance(x, str) else x for x in (key, value)]
            full.append((topic, partition, offset, moment or datetime(2026, 9, 7, 10), *map(
                lambda b: None if b is None else bytearray(b), as_bytes), headers))
        return spark.createDataFrame(full, LOG_SCHEMA)
    return build

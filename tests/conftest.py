import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyrank.session import build_session  # noqa: E402
from tallyrank.sources.tables import Tables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


RATINGS = [[2, 0, 4, 5], [0, 3, 3, 0], [1, 4, 0, 2], [5, 0, 0, 0], [0, 2, 5, 1]]


@pytest.fixture(scope="session")
def ratings(spark):
    rows = [(u, i, float(r), 100 * u + i) for u, line in enumerate(RATINGS) for i, r in enumerate(line) if r]
    return spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE, ts BIGINT")

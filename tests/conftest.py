import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.corpora import CASE_SCHEMA, CUSTOMER_SCHEMA, INGEST_CASES, SEARCH_CASES  # noqa: E402
from tidemark.session import get_session  # noqa: E402

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return get_session("local[4]", shuffle_partitions=8, app_name="tidemark-tests")


@pytest.fixture
def customers(spark):
    rows = [(i, f"Berth {i}", f"berth{i}@example.org", "NO", BASE + timedelta(days=i))
            for i in range(1, 6)]
    return spark.createDataFrame(rows, CUSTOMER_SCHEMA)


@pytest.fixture
def cases(spark):
    rows = [(a, b, c, d, "open", BASE + timedelta(days=e)) for a, b, c, d, e in INGEST_CASES]
    return spark.createDataFrame(rows, CASE_SCHEMA)


@pytest.fixture
def search_cases(spark):
    rows = [(a, 1, b, c, "open", BASE) for a, b, c in SEARCH_CASES]
    return spark.createDataFrame(rows, CASE_SCHEMA)

import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import types as T  # noqa: E402

ENTRY_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("level", T.StringType()),
    T.StructField("logger", T.StringType()),
    T.StructField("message", T.StringType()),
])

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from logpulse.session import local_session

    return local_session("*", shuffle_partitions=8, app_name="logpulse-tests")


@pytest.fixture
def make_entries(spark):
    def make(rows):
        return spark.createDataFrame(
            [(r[0], r[1], r[2] if len(r) > 2 else "T", r[3] if len(r) > 3 else "m") for r in rows],
            ENTRY_SCHEMA)
    return make


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)

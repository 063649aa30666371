import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridloom.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="*", shuffle_partitions=8)


def cells(spark, rows, value="v", schema=None):
    """Small hand-made cell frames: rows of (time, rlat, rlon, v)."""
    schema = schema or f"time timestamp_ntz, rlat int, rlon int, {value} double"
    return spark.createDataFrame(rows, schema)


def t(*args):
    return dt.datetime(*args)

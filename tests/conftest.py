from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marketstream.session import build_session

    s = build_session("*", app="marketstream-tests", shuffle_partitions=8)
    yield s
    s.stop()


def raw_df(spark, messages: list, start: int = 0):
    """A raw feed from JSON texts (or None) in the given order."""
    import datetime as dt

    from marketstream.schemas import RAW_FEED

    t0 = dt.datetime(2024, 1, 1)
    rows = [(start + i, t0 + dt.timedelta(seconds=i), m) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, RAW_FEED)

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
# Python workers import the package from here
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketstream.session import build_session

    s = build_session("*", app="llm-tests", shuffle_partitions=4)
    yield s
    s.stop()


ODD = [(1, "same words here for all of us to read", "en", "s", 1, "x"),
       (1, "same words here for all of us to read", "en", "s", 1, "x"),
       (2, "same words here for all of us to read", None, None, None, None),
       (3, "", "en", "s", 0, "x"), (4, None, None, "s", None, "x"),
       (5, " \t\n ", "fr", "s", 4, "x"), (None, "no id", "en", "s", 5, "x"),
       (None, None, None, None, None, None),
       (6, "x" * 300_000, "en", "s", 300_000, "x"), (7, "ab " * 60_000, "en", "s", 180_000, "x"),
       (8, "12 34 é漢😀\x00 <b>&amp;</b> ▁", "de", "s", 9, "x")]
ODD_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "id string")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and very long texts, repeated rows, and
    an extra column whose name clashes with those used inside."""
    df = spark.createDataFrame(ODD, ODD_SCHEMA)
    for c in ("size", "h", "n", "grams", "uid", "length", "x", "score", "range", "piece"):
        from pyspark.sql import functions as F

        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")

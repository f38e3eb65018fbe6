"""The driver contract: entry() smoke, every query has an oracle with the same columns,
and a sample of queries equals its DuckDB oracle at sf0.001."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import rows_key  # noqa: E402


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["exchange", "symbol", "side", "price", "ts", "receipt_ts", "size",
                          "trade_id", "epoch"]
    rows = df.collect()
    assert len(rows) == 1000 and rows[0].ts >= rows[-1].ts


def test_every_query_has_an_oracle():
    from marketstream.plans.queries import all_queries

    assert set(all_queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return c


@pytest.mark.parametrize("name", ["tickers", "route_counts", "trades_normalised", "l2_book",
                                  "l2_deltas", "book_record", "l3_book", "seq_verdicts",
                                  "trades_with_order_type", "l3_gated_book", "l2_deltas_chunked",
                                  "two_venue_book", "l3_deltas_chunked", "unknown_makers",
                                  "rejects_all", "seq_verdicts_chunked", "mixed_gated"])
def test_query_equals_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows, scols = df.collect(), df.columns
    r = con.sql(E.oracle_sql()[name])
    assert sorted(scols) == sorted(r.columns)
    assert rows_key(scols, srows) == rows_key(r.columns, r.fetchall())

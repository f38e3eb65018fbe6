"""Record sinks: topic writer (file stand-in), null replacement, book record order, console."""

from __future__ import annotations

import json
from decimal import Decimal

from marketstream.session import fresh_dir
from marketstream.streaming.sinks import (book_record_json, book_records, console, trade_records,
                                          write_records)


def test_trade_record_none_to_and_topic_writer(spark):
    t = spark.createDataFrame(
        [("COINBASE", "BTC-USD", None, Decimal("1.5"), Decimal("10"), 1, 2, "7")],
        "exchange string, symbol string, side string, amount decimal(38,18), "
        "price decimal(38,18), ts long, receipt_ts long, trade_id string")
    rec = trade_records(t, none_to="").collect()[0]
    assert json.loads(rec.value)["side"] == ""
    assert "side" not in json.loads(trade_records(t).collect()[0].value)   # null dropped
    path = fresh_dir(spark, "topic")
    write_records(trade_records(t), "trade", fmt="json", path=path)
    back = spark.read.json(f"{path}/trade").collect()
    assert back[0].key == "BTC-USD" and json.loads(back[0].value)["size"] == 1.5


def test_book_record_sides_sorted_and_capped(spark):
    book = spark.createDataFrame(
        [("X-Y", "bid", Decimal(p), Decimal(1)) for p in (3, 5, 4)]
        + [("X-Y", "ask", Decimal(p), Decimal(2)) for p in (9, 7, 8)],
        "symbol string, side string, price decimal(38,18), amount decimal(38,18)")
    r = json.loads(book_record_json(book_records(book)).collect()[0].value)
    assert [x["price"] for x in r["bid"]] == [5.0, 4.0, 3.0]
    assert [x["price"] for x in r["ask"]] == [7.0, 8.0, 9.0]
    r = json.loads(book_record_json(book_records(book, depth=2)).collect()[0].value)
    assert len(r["bid"]) == 2 and r["ask"][0] == {"price": 7.0, "size": 2.0}


def test_console_writer_is_a_stream_writer(spark):
    s = spark.readStream.format("rate").load()
    w = console(s)
    assert type(w).__name__ == "DataStreamWriter"
